import html as lib
import random
import re
import tracemalloc

import pytest

from fleetlake.llm import html


def text_of(source, template=()):
    root = html.parse(source)
    return html.main_text(root, html.subtree_hashes(root), frozenset(template))


def page(body, i=0):
    return f"<html><head><title>T{i}</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "source,expected",
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a &lt;b&gt; <i>c</i>d<p>e&nbsp; f<br>g", "a <b> cd e f g"),
        ("<p>one<script>var a = '</p><p>no';</script>two", "onetwo"),
        ("<table><tr><td>x<td>y<tr><td>z</table>", "x y z"),
        ("<nav>menu</nav><article><h1>T</h1><p>x</p><aside>s</aside></article><footer>f</footer>", "T x"),
        ("<body class='has-sidebar'><div class='side-bar sidebar'>s</div><main>m<form>f</form></main>o", "m"),
        ("<article>long enough text</article><article class=comment>" + "c" * 99 + "</article>", "long enough text"),
        ("<div id=comments>no</div><div class='adslot'>no</div><div class='shadow'>yes</div>", "yes"),
        ("<article><header><h2>Head</h2></header>t</article><header>site</header>", "Head t"),
        ("<header>site</header><p>t</p>", "t"),
        ("<p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d</p>", "d"),
        ("a <!-- no <p> --> b <![CDATA[no]]> <!doctype x> c < d & e &amp;lt; f", "a b c < d & e &lt; f"),
        ("<p title='a > b'>x</p><p class=\"open>y</p>", "x y"),
        ("<p>x</b></div>y</p><", "xy <"),
        ("<DIV>A<P>B</DIV>C", "A B C"),
        ("<ul><li>1<ul><li>2</ul><li>3</ul>", "1 2 3"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 10 + "</article>", "deep"),
    ],
)
def test_main_text(source, expected):
    assert text_of(source) == expected


@pytest.mark.parametrize(
    "source,expected",
    [
        ("<div class='content has-sidebar'><article><p>text</p></article></div><p>beside</p>", "text"),
        ("<div id='no-nav'><p>text</p></div>", "text"),
        ("<form id=aspnetForm><input><div><h2>T</h2><p>all of the text</p></div></form><div>top</div>", "T all of the text top"),
        ("<div class='related'><article><h1>r</h1>" + "r" * 99 + "</article></div><article>t</article>", "t"),
        ("<form><main><h1>T</h1>text<form>f</form></main></form>", "T text"),
        ("<div class='sidebar-left'><article><h1>T</h1>text</article><div class=sidebar>s</div></div><p>more than half of it here</p>", "T text"),
        ("<article><h2 id='related-work'>Related work</h2><section id='discussion'>d</section><h2 id=reviews>R</h2></article>", "Related work d R"),
        ("<section id=comments><article>c</article></section><p>t</p>", "t"),
        ("<div class='related-posts'><article>" + "r" * 99 + "</article></div><p>t</p>", "t"),
        ("<div class='site-footer'>f</div><div class='ad-slot-3'>a</div><div id='mainNav'>n</div><p class='ad-free'>t</p>", "t"),
        ("<p>t</p><aside><article><h1>a</h1>a</article></aside>", "t"),
    ],
)
def test_names_drop_no_main_text(source, expected):
    assert text_of(source) == expected


@pytest.mark.parametrize(
    "source,expected",
    [
        ("<div><article>one</article><aside>s</aside><article>two long</article> beside <article>three</article></div><p>o</p>", "one two long three"),
        ("<main><h1>Head</h1><p>lead</p><article>one</article><div><article>two</article></div><nav>n</nav>end</main>o", "Head lead one two end"),
        ("<main><header><h1>Head</h1></header><article>a<article class=reply>r</article></article></main>", "Head a"),
        ("<div role=main><h1>Head</h1><article>a</article></div><div>o</div>", "Head a"),
    ],
)
def test_all_articles_of_the_main_element(source, expected):
    assert text_of(source) == expected


STORY = "".join(f"<p>Paragraph {i} of the story.</p>" for i in range(20))
STORY_TEXT = " ".join(f"Paragraph {i} of the story." for i in range(20))


@pytest.mark.parametrize(
    "source,expected",
    [
        ("<article>Short teaser</article><div class='story'><h1>T</h1>" + STORY + "</div>", "Short teaser T " + STORY_TEXT),
        ("<article>one</article><article>two</article>" + STORY + "<nav>n</nav>", "one two " + STORY_TEXT),
        ("<article><p>Other</p></article><div itemprop=articleBody>" + STORY + "</div>", STORY_TEXT),
        ("<article>" + STORY + "</article><p>Beside it.</p><div>" + "long menu " * 99 + "</div>", STORY_TEXT),
        ("<article><h1>T</h1>short</article>" + STORY, "T short"),
        ("<article><header><div><h2>Head</h2></div></header>t</article>", "Head t"),
        ("<article><header><p>Lead.</p></header>t</article>", "Lead. t"),
        ("<article><header>By line</header>t</article>", "t"),
        ("<p>AT&<b>copy</b> &am<i>p;</i> &lt<b>b</b>", "AT&copy &amp; <b"),
    ],
)
def test_teasers_headers_and_split_references(source, expected):
    assert text_of(source) == expected


def test_template_is_what_recurs_on_many_articles(spark):
    rows = []
    for i in range(12):
        box = "<div><p>Read more of our fine site every day</p></div>"
        body = f"<div>Our site</div><article><h1>N{i}</h1><p>Text number {i} here.</p>{box}<p>Of.</p></article><div>So long</div>"
        rows.append((i, f"http://User@A.example.com:80/{i}", page(body, i)))
    # Copies of one article are one article.
    rows += [(100 + i, f"//b.example.com/{i}", page(f"<article><p>The same text.</p><p>{'more ' * 9}</p></article><p>{i}</p>")) for i in range(20)]
    # Few pages have no template, and hosts don't mix.
    rows += [(200 + i, "c.example.com/x", page(f"<p>Our site</p><p>alone {i}</p>")) for i in range(4)]
    rows += [(300, None, None), (301, "http://a.example.com/", ""), (302, None, page("<p>x</p>")), (302, None, page("<p>x</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "'t' AS text", "2 AS template").repartition(4)
    got = {}
    for r in html.extract_text(df).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert all(got[i] == [f"N{i} Text number {i} here."] for i in range(12))
    assert all(got[100 + i] == ["The same text. " + ("more " * 9).strip()] for i in range(20))
    assert all(got[200 + i] == [f"Our site alone {i}"] for i in range(4))
    assert (got[300], got[301], got[302]) == ([""], [""], ["x", "x"])
    assert html.extract_text(df.limit(0)).collect() == []


def test_near_copies_and_quoted_passages_are_no_template(spark):
    rnd = random.Random(5)

    def paragraphs(n):
        return [" ".join(f"w{rnd.randrange(3000)}" for _ in range(20)) for _ in range(n)]

    def changed(text):
        words = text.split()
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        return " ".join(words)

    quoted, box = paragraphs(1)[0], "Read more of our fine site every day"
    expected = {}
    for host, copies, others, inner in (("a", 5, 10, "article"), ("b", 5, 1, "article"), ("c", 12, 12, "article"), ("d", 6, 12, "div"), ("e", 20, 0, "main")):
        first = paragraphs(6)
        for i in range(copies):
            # A word changed in one of the paragraphs.
            k = rnd.randrange(6)
            expected[host, inner, i] = [changed(p) if j == k else p for j, p in enumerate(first)]
        for i in range(copies, copies + others):
            # A third of the others quote one passage.
            expected[host, inner, i] = paragraphs(4) + ([quoted] if inner == "article" and i % 3 == 0 else [])
    rows = []
    for n, ((host, inner, _), texts) in enumerate(expected.items()):
        body = "".join(f"<p>{p}</p>" for p in texts) + (f"<div>{box}</div>" if host in "cd" else "")
        rows.append((n, f"http://{host}.example.com/{n}", page(f"<{inner}>{body}</{inner}>")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html.extract_text(df).collect()}
    for n, texts in enumerate(expected.values()):
        assert got[n] == " ".join(texts)


def test_joined_by_host_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    small = sorted(map(tuple, html.extract_text(df).collect()))
    monkeypatch.setattr(html, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, html.extract_text(df).collect())) == small


@pytest.mark.parametrize("tag,expected", [("<p title={}>", "t"), ("<p {}\">", "t"), ("<p title='{}'>", "t")])
def test_long_tags_take_no_memory_by_character(tag, expected):
    source = tag.format("a" * 2_000_000) + "t"
    tracemalloc.start()
    try:
        assert text_of(source) == expected
        assert tracemalloc.get_traced_memory()[1] < 20 * len(source)
    finally:
        tracemalloc.stop()


def test_few_files_however_many_partitions_a_shuffle_has(spark, monkeypatch):
    rows = [(100 * h + i, f"http://h{h}.example.com/{i}", page(f"<div>Site {h}</div><p>Text {h} of {i}.</p>")) for h in range(12) for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    files, store = {}, html.stored

    def counted(df, label):
        kept = store(df, label)
        files[label] = len(kept.inputFiles())
        return kept

    monkeypatch.setattr(html, "stored", counted)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = {r.page_id: r.text for r in html.extract_text(df).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {100 * h + i: f"Text {h} of {i}." for h in range(12) for i in range(8)}
    assert max(files["weights"], files["templates"]) <= files["subtrees"] <= 2


def test_pages_of_the_table(spark):
    """The table's pages have one flat article each: its tags cut out by a regular expression."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html.extract_text(df).collect()}
    for r in df.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        assert got[r.page_id] == " ".join(lib.unescape(re.sub("<[^>]*>", " ", article)).split())
