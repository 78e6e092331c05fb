import hashlib
import random
from collections import defaultdict

import pytest

from fleetlake.llm import alignment
from fleetlake.llm.alignment import TOKENIZER_A, TOKENIZER_B, align, align_tokens, byte_letters, load

from .helpers import documents

MORE = ["<|endoftext|> as plain text</s>", "▁ is lost", "a▁b", "\x00 zero", "tab\tand\n\nlines  ", "naïve café", "don't  stop", "aaaaaaaaaaaaaaaaaaaaaaa", "ééééé 漢字 😀😀", "<0x41>"]


def overlaps(text):
    """Groups and links by comparing the byte ranges of all tokens, one text at a time."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(TOKENIZER_A), SentencePieceProcessor(model_file=TOKENIZER_B)
    one.encode_special_tokens = True
    letters = byte_letters()
    a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()) for i in two.encode(text)]
    whole = (" " + text).encode()
    if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
        return 0, 0, [], []

    def ranges(side):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    a, b = ranges(a), ranges(b)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, start = [], 0
    for cut in cuts:
        groups.append(tuple(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
        start = cut
    links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] if len(a) < 900 else []
    return len(a), len(b), groups, links


def brute(texts):
    found = [overlaps(t or "") for t in texts]
    counts = defaultdict(int)
    for _, _, _, links in found:
        for pair in set(links):
            counts[pair] += 1
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for n_a, n_b, groups, links in found:
        text = ";".join("|".join(g) for g in groups)
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return rows, dict(counts)


def columns(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256)


@pytest.fixture(scope="module")
def short_rows(rows):
    """All awkward documents but the longest: the brute force compares all tokens of a text."""
    short = [r for r in rows if len(r[1] or "") < 1000]
    return short + [(9000 + i, t, "en", "a", len(t)) for i, t in enumerate(MORE)]


@pytest.mark.parametrize("most_hot", [alignment.MOST_HOT, 20])
def test_against_all_ranges(spark, short_rows, monkeypatch, most_hot):
    """With few hot pairs, so that the join of the others is met too."""
    monkeypatch.setattr(alignment, "MOST_HOT", most_hot)
    docs, pairs = align_tokens(documents(spark, short_rows))
    expected, counts = brute([r[1] for r in short_rows])
    got = sorted(((r.doc_id is not None, r.doc_id or 0, *columns(r)) for r in docs.collect()))
    assert got == sorted((r[0] is not None, r[0] or 0, *e) for r, e in zip(short_rows, expected, strict=True))
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == counts


def test_long_texts_and_portions(spark, rows, monkeypatch):
    """A text's alignment does not depend on what it is encoded with."""
    model = load(TOKENIZER_A, TOKENIZER_B)
    texts = [r[1] or "" for r in rows]
    whole = align(model, texts)
    alone = [align(model, [t]) for t in texts]
    assert whole.groups == [x.groups[0] for x in alone]
    assert whole.n_links.tolist() == [int(x.n_links[0]) for x in alone]
    assert (whole.n_links == whole.n_a + whole.n_b - whole.n_groups).all()
    monkeypatch.setattr(alignment, "AT_ONCE", 500)
    docs, _ = align_tokens(documents(spark, rows))
    assert sorted(r.groups_sha256 for r in docs.collect()) == sorted(hashlib.sha256(g.encode()).hexdigest() if g else "" for g in whole.groups)


def test_identity_map():
    model = load(TOKENIZER_A, TOKENIZER_B)
    known = [(i, j) for i, j in enumerate(model.same.tolist()) if j >= 0]
    assert len(known) > 5000
    assert all(model.a.bytes[i] == model.b.bytes[j] for i, j in known)


def test_encoding_by_ranks_equals_encoding_by_merges():
    """On words, on random letters and on bytes of the vocabulary itself."""
    from tokenizers import Tokenizer

    model, rnd = load(TOKENIZER_A, TOKENIZER_B), random.Random(4)
    one = Tokenizer.from_file(TOKENIZER_A)
    one.encode_special_tokens = True
    entries = [e.decode("utf-8", "ignore") for e in model.a.bytes]
    texts = [e for e in entries if e] + MORE
    texts += ["".join(rnd.choice(entries) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    texts += ["".join(rnd.choice("aeinrst' .1\n\u00a0\u0085é") for _ in range(rnd.randint(1, 200))) for _ in range(1500)]
    assert model.encode_a(texts) == [e.ids for e in one.encode_batch(texts, add_special_tokens=False)]


def test_empty_table(spark, no_docs):
    docs, pairs = align_tokens(no_docs)
    assert docs.collect() == [] and pairs.collect() == []
