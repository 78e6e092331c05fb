"""Main text of web pages by site template removal.

Pages are parsed once to hash their element subtrees; Spark counts, per host, in how many different
articles' pages each subtree occurs. Subtrees that recur across many of them are the site's template.
Near copies of an article count as about one: an article weighs 1 / the number of articles that have its
less common word sequences. Within an article or main element a subtree must be on most of the host's articles.
In a second parse they are deleted, along with elements that by tag, role, class or id are never
main text, and what is left of the article is joined block by block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: A subtree is template if it is on the pages of so many articles of the host, at least, and on this share.
MANY, SHARE = 5, 0.3
#: Within an article or main element it must be on more than this share: less may be a passage that articles quote.
INSIDE = 0.5
#: Sequences of so many words are compared, the smallest hashes of each article; this share of them is its own if it is no near copy.
WORDS, SAMPLE, OWN = 3, 48, 0.25
#: Weights are summed as whole numbers, so that the order of rows doesn't matter.
_ONE = 10**9
#: Rows of templates that are broadcast at most; beyond that Spark joins by host.
BROADCAST_HOSTS = 20_000

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: An open element of the value ends where an element of the key begins.
_PARAGRAPH_ENDS = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul"
CLOSES = {tag: ("p",) for tag in _PARAGRAPH_ENDS.split()} | {
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "thead": ("tr", "td", "th", "p"),
    "tbody": ("thead", "tbody", "tr", "td", "th", "p"),
    "tfoot": ("tbody", "tr", "td", "th", "p"),
    "option": ("option",),
    "optgroup": ("option", "optgroup"),
    "body": ("head",),
}
#: Implied ends don't reach out of these.
SCOPES = frozenset("table ul ol dl td th article section main body html div blockquote form".split())
#: Never main text.
DROPPED_TAGS = frozenset(
    "script style noscript template svg math canvas object embed iframe audio video map nav footer aside form button select option input textarea dialog menu head title meta link fieldset datalist noframes noembed xmp".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Whole names in class and id that mark what isn't main text.
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo promos promotion
    banner banners cookie cookies consent gdpr notice notices notification notifications alert popup popups modal overlay
    newsletter subscribe subscription signup signin login share sharing social menu menus nav navbar navigation breadcrumb
    breadcrumbs sidebar sidebars rail footer foot masthead topbar toolbar pagination pager related recommended recommendations
    trending comment comments commentlist disqus discussion replies reply reviews widget widgets skip hidden paywall""".split()
)
#: Those that mark it as the first or last word of a longer name too (``ad-slot``, ``site-footer``), unless a word of state is in the name.
DROPPED_PARTS = frozenset(
    """ad ads advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo promos banner banners cookie cookies
    gdpr popup popups modal newsletter menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars footer masthead topbar toolbar
    pagination pager comments commentlist disqus widget widgets""".split()
)
STATES = frozenset(
    "has have no not non with without is in on off show shown hide can use free open opened close closed active enabled disabled collapsed expanded visible".split()
)
#: Longer names of words that are common in headings.
DROPPED_NAMES = frozenset(
    """related-posts related-articles related-stories related-links related-content related-news recommended-articles recommended-posts
    comment-list comment-form comment-section comments-area social-share social-links social-media social-icons share-buttons share-bar
    share-links sharing-buttons skip-link skip-links skip-nav skip-to-content login-form signup-form subscribe-form cookie-consent""".split()
)
#: An element so named is no wrapper of the article, however much of the page it holds.
_AFTER_TEXT = frozenset("comment comments commentlist disqus discussion reply replies review reviews related recommended recommendations trending".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_TITLE = frozenset(["h1"])
#: What running text is written in.
_PARAGRAPHS = frozenset("p blockquote pre".split())
#: A header of the main element with one of these belongs to the text.
_LEAD = _HEADINGS | _PARAGRAPHS
#: Kept whatever their class says; of articles go only those that these words mark.
_KEPT_TAGS = frozenset(["html", "body", "main"])
DROPPED_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment comments reply replies related recommended".split())
#: Possessive within tags: no state is kept for each character of a long one.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|</?[a-zA-Z][^<>]*>?", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_WORDS = re.compile(r"[a-z]+|\d+")
#: Words between spaces, and single characters of scripts without spaces.
_SPACED = re.compile("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]|[^\\s\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    """A tag, what is inside (texts and elements, in order) and whether it can't be main text.

    ``marked`` is "main" or "article" if attributes say so. ``maybe`` elements are dropped for their
    names, or as forms, and kept after all if they turn out to be wrapped round the main text.
    """

    __slots__ = ("tag", "inside", "dropped", "marked", "maybe")

    def __init__(self, tag: str, dropped: bool = False, marked: str = "", maybe: str = ""):
        self.tag, self.dropped, self.marked, self.maybe = tag, dropped, marked, maybe
        self.inside: list = []


def _named(names: str, tag: str) -> str:
    """The first of the names that says an element of the tag isn't main text, or nothing."""
    for name in names.split():
        words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
        whole = "".join(words)
        if whole in (DROPPED_ARTICLES if tag == "article" else DROPPED_WORDS):
            return whole
        words = [w for w in words if not w.isdigit()]
        if tag == "article" or not words or not STATES.isdisjoint(words):
            continue
        if words[0] in DROPPED_PARTS or words[-1] in DROPPED_PARTS or "-".join(words) in DROPPED_NAMES:
            return words[0]
        if len(words) == 1 and words[0] in DROPPED_WORDS:
            return words[0]
    return ""


def _judged(tag: str, source: str, stack: list[Element]) -> Element:
    """The element of a start tag, inside those on the stack."""
    attributes = {}
    if " " in source or "\n" in source or "\t" in source:
        for name, a, b, c in _ATTRIBUTE.findall(source, len(tag) + 1):
            attributes.setdefault(name.lower(), a or b or c)
    dropped = tag in DROPPED_TAGS
    maybe = tag if tag == "form" else ""
    marked = ""
    if attributes and (maybe or not dropped):
        role = attributes.get("role", "").lower()
        marked = "main" if role == "main" or attributes.get("itemprop", "") == "articleBody" else "article" if role == "article" else ""
        if tag not in _KEPT_TAGS:
            style = attributes.get("style", "").replace(" ", "").lower()
            names = attributes.get("class", "")
            # The ids of headings, and of an article's sections, are made from what they say.
            if "id" in attributes and tag not in _HEADINGS and not (tag == "section" and any(e.tag == "article" or e.marked for e in stack)):
                names += f" {attributes['id']}"
            named = _named(html.unescape(names), tag) if names else ""
            surely = (
                (role in DROPPED_ROLES and role != "form")
                or "hidden" in attributes
                or attributes.get("aria-hidden", "").lower() == "true"
                or "display:none" in style
                or "visibility:hidden" in style
            )
            maybe = "" if surely or tag == "article" else named or maybe or (role if role == "form" else "")
            dropped = bool(dropped or surely or named or maybe)
    return Element(tag, dropped, marked, maybe)


def _keep_wrappers(root: Element, maybe: list[Element]) -> None:
    """Keep those elements that are wrapped round the main text.

    They hold a ``main`` element or an article with an ``h1``, or else more than half of the page's text
    and are a form, hold an ``h1``, or the only articles.
    """
    sizes: dict[int, int] = {}
    holds: dict[int, set[str]] = {}
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(e for e in element.inside if isinstance(e, Element) and (not e.dropped or e.maybe))
    for element in reversed(order):
        size, kinds = 0, set()
        for e in element.inside:
            if isinstance(e, str):
                size += len(e) - e.count(" ")
            elif id(e) in sizes:
                size += sizes[id(e)]
                kinds |= holds[id(e)]
        if element.tag == "main" or element.marked == "main":
            kinds.add("main")
        elif element.tag == "article" or element.marked == "article":
            kinds.update(["article", "headed"] if "h1" in kinds else ["article"])
        elif element.tag == "h1":
            kinds.add("h1")
        sizes[id(element)], holds[id(element)] = size, kinds
    outside, todo = False, [root]
    while todo and not outside:
        element = todo.pop()
        outside = element.tag in ("article", "main") or bool(element.marked)
        todo.extend(e for e in element.inside if isinstance(e, Element) and not e.dropped)
    for element in maybe:
        kinds = holds.get(id(element), set())
        wraps = "main" in kinds
        if element.maybe not in _AFTER_TEXT:
            most = 2 * sizes.get(id(element), 0) > sizes[id(root)]
            wraps |= "headed" in kinds or (most and (element.maybe == "form" or "h1" in kinds or ("article" in kinds and not outside)))
        if wraps:
            element.dropped = False


def parse(source: str) -> Element:
    """The element tree of a page, with the usual repairs: implied ends, stray ends skipped, open ends closed."""
    root = Element("#root")
    stack, at = [root], 0
    maybe: list[Element] = []
    while at < len(source):
        token = _TOKEN.search(source, at)
        if token is None:
            stack[-1].inside.append(source[at:])
            break
        if token.start() > at:
            stack[-1].inside.append(source[at : token.start()])
        at = token.end()
        name = _NAME.match(source, token.start())
        if name is None:
            continue
        tag = name[1].lower()
        if source.startswith("</", token.start()):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            else:
                if tag == "p":
                    stack[-1].inside.append(Element("p"))
            continue
        closes = CLOSES.get(tag)
        if closes:
            depth = len(stack) - 1
            while depth > 0 and (stack[depth].tag in closes or stack[depth].tag not in SCOPES):
                if stack[depth].tag in closes:
                    del stack[depth:]
                depth -= 1
        element = _judged(tag, token[0], stack)
        stack[-1].inside.append(element)
        if element.maybe:
            maybe.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b", re.IGNORECASE).search(source, at)
            at = end.start() if end else len(source)
            if end:
                at = source.find(">", at) + 1 or len(source)
        elif tag not in VOID and not token[0].endswith("/>"):
            stack.append(element)
    if maybe:
        _keep_wrappers(root, maybe)
    return root


def subtree_hashes(root: Element) -> dict[int, int]:
    """Hash of tag and content by ``id`` of each block element, dropped ones left out."""
    hashes: dict[int, int] = {}

    # Without recursion: pages may nest deeper than Python's stack.
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(e for e in element.inside if isinstance(e, Element) and not e.dropped)
    inner: dict[int, str] = {}
    for element in reversed(order):
        parts = [e if isinstance(e, str) else inner.get(id(e), "") for e in element.inside]
        content = " ".join(" ".join(parts).split())
        digest = xxhash.xxh64_intdigest(f"{element.tag}\0{content}") - (1 << 63)
        # A parent sees a child by its hash, so that long texts are hashed once.
        inner[id(element)] = f"{element.tag}:{digest}" if content or element.tag in VOID else ""
        if content and element.tag not in INLINE:
            hashes[id(element)] = digest
    return hashes


def _length(element: Element) -> int:
    total, todo = 0, [element]
    while todo:
        for e in todo.pop().inside:
            if isinstance(e, str):
                total += len(e) - e.count(" ")
            elif not e.dropped:
                todo.append(e)
    return total


def _holds(element: Element, tags: frozenset[str]) -> bool:
    todo = [element]
    while todo:
        for e in todo.pop().inside:
            if isinstance(e, Element) and not e.dropped:
                if e.tag in tags:
                    return True
                todo.append(e)
    return False


def _is_teaser(chosen: Element, articles: list[Element], root: Element) -> bool:
    """The articles have no ``h1``, and paragraphs outside all articles hold more than twice the text of the chosen ones."""
    if any(_holds(article, _TITLE) for article in articles):
        return False
    outside, todo = 0, [root]
    while todo:
        for e in todo.pop().inside:
            if isinstance(e, Element) and not e.dropped and e.tag != "article":
                if e.tag in _PARAGRAPHS:
                    outside += _length(e)
                else:
                    todo.append(e)
    return outside > 2 * _length(chosen)


def main_element(root: Element) -> Element:
    """What holds the main text: the longest article, with what belongs to it; else the longest marked or ``main`` element; else the page.

    If the article is in a ``main`` element, that is taken, with its other articles and the text beside
    them. Else it is taken together with the articles next to it, in page order, in an element of their own.
    Articles that only tease, beside a longer story in paragraphs, are no reason to leave the story out.
    """
    articles, mains, todo = [], [], [(root, root, None)]
    while todo:
        element, parent, main = todo.pop()
        if element.tag == "article":
            articles.append((element, parent, main))
        elif element.tag == "main" or element.marked:
            mains.append(element)
            if element.tag == "main" or element.marked == "main":
                main = main or element
        todo.extend((e, element, main) for e in reversed(element.inside) if isinstance(e, Element) and not e.dropped)
    if articles:
        article, parent, main = max(articles, key=lambda found: _length(found[0])) if len(articles) > 1 else articles[0]
        if main is not None:
            return main
        siblings = [e for e in parent.inside if isinstance(e, Element) and e.tag == "article" and not e.dropped]
        chosen = article
        if len(siblings) > 1 and parent.tag != "article":
            chosen = Element("#articles")
            chosen.inside = siblings
        if not _is_teaser(chosen, [found[0] for found in articles], root):
            return chosen
    return max(mains, key=_length) if mains else root


def main_text(root: Element, hashes: dict[int, int], template: frozenset[int]) -> str:
    """The main element's blocks without dropped and template subtrees, one space between words and blocks.

    ``header`` counts as a page's header unless it is inside the main element and holds a heading or a
    paragraph. Character references are decoded text by text, so tags within one end it.
    """
    main = main_element(root)
    parts: list[str] = []
    todo: list = [main]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            # After parsing, so that what references stand for is never taken for markup.
            parts.append(html.unescape(item))
            continue
        if item.dropped or (item is not main and hashes.get(id(item)) in template):
            continue
        if item.tag == "header" and (main is root or not _holds(item, _LEAD)):
            continue
        if item.tag not in INLINE:
            parts.append(" ")
            todo.append(" ")
        todo.extend(reversed(item.inside))
    return " ".join("".join(parts).split())


def word_sequences(text: str) -> list[int]:
    """The smallest hashes of the text's sequences of ``WORDS`` words: equal sequences are sampled alike."""
    words = text.split() if text.isascii() else _SPACED.findall(text)
    sequences = {" ".join(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))} if words else ()
    return [h - (1 << 63) for h in sorted(map(xxhash.xxh64_intdigest, sequences))[:SAMPLE]]


def host_key(url: Column) -> Column:
    """A hash of the URL's host, without user, port and letter case; URLs without host share one."""
    host = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.xxhash64(F.lower(F.coalesce(host, F.lit(""))))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            yield whole.slice(start, 256)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _batches(batches):
        articles, sequences, hashes = [], [], []
        for page in batch.column(1).to_pylist():
            root = parse(page or "")
            text = main_text(root, {}, frozenset())
            articles.append(xxhash.xxh64_intdigest(text) - (1 << 63))
            sequences.append(word_sequences(text))
            hashes.append(sorted(set(subtree_hashes(root).values())))
        lists = [pa.array(lists, pa.list_(pa.int64())) for lists in (sequences, hashes)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(articles, pa.int64()), *lists], ["host", "article", "sequences", "subtrees"])


def _weights(articles: DataFrame) -> DataFrame:
    """``host``, ``article`` and its ``weight``, of ``_ONE`` for one that is no near copy of others.

    A share ``OWN`` of an article's word sequences is in so many of the host's articles, at most, as it
    stands for. The near copies of one article thus weigh about as much as one, however many they are.
    """
    each = articles.select("host", "article", F.explode_outer("sequences").alias("sequence"))
    shared = each.groupBy("host", "sequence").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    met = each.join(shared, ["host", "sequence"], "left").groupBy("host", "article")
    sizes = met.agg(F.sort_array(F.collect_list(F.coalesce("n", F.lit(1)))).alias("sizes"))
    size = F.element_at("sizes", F.ceil(F.size("sizes") * OWN).cast("int"))
    return sizes.select("host", "article", F.floor(F.lit(_ONE) / size).alias("weight"))


def site_templates(pages: DataFrame, many: int = MANY, share: float = SHARE, inside: float = INSIDE) -> DataFrame:
    """``host`` (hashed), its ``template``, the subtrees that recur on its pages, and those on ``most`` of them.

    Pages with equal main texts count once and near copies by their weight, so copies of an article don't
    make it a template. A host's list is bounded: those that weigh ``share`` of all, at least.
    """
    found = pages.select(host_key(F.col("url")).alias("host"), "html").mapInArrow(
        _subtrees, "host long, article long, sequences array<long>, subtrees array<long>"
    )
    found = stored(found, "subtrees")
    # What follows is smaller than the subtrees: no more files than theirs, however many partitions a shuffle has.
    files = max(1, len(found.inputFiles()))
    weights = stored(_weights(found.select("host", "article", "sequences").distinct()).coalesce(files), "weights")
    articles = weights.groupBy("host").agg(F.sum("weight").alias("articles"))
    each = found.select("host", "article", F.explode("subtrees").alias("subtree")).distinct().join(weights, ["host", "article"])
    counted = each.groupBy("host", "subtree").agg(F.sum("weight").alias("n")).where(F.round(F.col("n") / _ONE, 3) >= many)
    recurring = counted.join(articles, "host").where(F.col("n") >= share * F.col("articles"))
    most = F.when(F.col("n") > inside * F.col("articles"), F.col("subtree"))
    return recurring.groupBy("host").agg(F.collect_list("subtree").alias("template"), F.collect_list(most).alias("most")).coalesce(files)


def extract_text(pages: DataFrame, many: int = MANY, share: float = SHARE, inside: float = INSIDE) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    A missing or empty page, or one without main text, has the empty text. Pages without a URL are
    one host. Repeated rows get equal results; an empty table gives an empty one. The texts of
    attributes, comments, scripts and styles are never taken for text.
    """
    templates = stored(site_templates(pages, many, share, inside), "templates")
    few = templates.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    rows = pages.select("page_id", "url", "html", host_key(F.col("url")).alias("host"))
    joined = rows.join(F.broadcast(templates) if few else templates, "host", "left").select("page_id", "url", "html", "template", "most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            texts = []
            for page, template, most in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                root = parse(page or "")
                deleted = template if main_element(root) is root else most
                texts.append(main_text(root, subtree_hashes(root) if deleted else {}, frozenset(deleted or ())))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
