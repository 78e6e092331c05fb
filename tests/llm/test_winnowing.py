import base64
import hashlib
import random

import numpy as np
import pytest

from fleetlake.llm import winnowing

from .helpers import documents, prose


def brute_places(text, k, w):
    """Rightmost least k-gram of each window, by the library's hash of each k-gram alone."""
    if not text:
        return []
    k = min(k, len(text))
    points = np.array([ord(c) for c in text], np.uint32)
    keys = [int(winnowing.gram_hashes(points[i : i + k], k)[0]) >> 20 for i in range(len(text) - k + 1)]
    w = min(w, len(keys))
    places = []
    for i in range(len(keys) - w + 1):
        least = min(keys[i : i + w])
        places.append(max(j for j in range(i, i + w) if keys[j] == least))
    return sorted(set(places))


@pytest.mark.parametrize("k,w", [(12, 20), (5, 4), (1, 1), (3, 7), (16, 1)])
def test_places(k, w):
    rnd = random.Random(k)
    for n in [*range(0, 45, 3), 300]:
        text = "".join(rnd.choice("abé😀") for _ in range(n))
        assert winnowing.winnow(text, k, w)[1].tolist() == brute_places(text, k, w)


def test_pieces_of_a_long_text_agree(monkeypatch):
    text = prose(random.Random(1), 3000)
    whole = winnowing.winnow(text)
    monkeypatch.setattr(winnowing, "PIECE", 97)
    parts = winnowing.winnow(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_shared_passages_leave_a_common_hash():
    rnd = random.Random(2)
    for _ in range(50):
        passage = prose(rnd, 30)[: winnowing.K + winnowing.W - 1].ljust(winnowing.K + winnowing.W - 1, "z")
        a, b = (prose(rnd, 10) + passage + prose(rnd, 10) for _ in range(2))
        assert set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())


def brute(rows):
    order = sorted(rows, key=lambda r: r[1] or "")
    order = sorted(order, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        prints = [winnowing.winnow(t)[0] for t in (text, edited, after)]
        a, b, c = (set(p.tolist()) for p in prints)
        near = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.printed(prints[0]), winnowing.printed(prints[1]), *near))
    return sorted(out, key=repr)


def test_awkward_rows(docs, rows):
    assert sorted(map(tuple, winnowing.compare_with_next(docs).collect()), key=repr) == brute(rows)


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "BUCKET_ROWS", 7)
    rnd = random.Random(4)
    rows = [(rnd.choice([i, i * 1000, 17]), prose(rnd, 20), "", "", 0) for i in range(90)]
    assert sorted(map(tuple, winnowing.compare_with_next(documents(spark, rows)).collect()), key=repr) == brute(rows)


def test_buckets_beyond_many(spark, monkeypatch):
    """Past ``MANY_BUCKETS`` the number of buckets goes on growing with the rows."""
    monkeypatch.setattr(winnowing, "MANY_BUCKETS", 2)
    monkeypatch.setattr(winnowing, "FULL_BUCKET", 9)
    rows = [(i, prose(random.Random(i), 20), "", "", 0) for i in range(100)]
    docs = documents(spark, rows)
    assert winnowing.in_order(docs).select("bucket").distinct().count() > 8
    got = {r.doc_id: r.edited_sha256 for r in winnowing.compare_with_next(docs).collect()}
    for i, (doc_id, text, *_) in enumerate(rows):
        after, changed = rows[i - 1][1], len(text) // 3
        edited = text[: len(text) - changed] + after[:changed]
        assert got[doc_id] == hashlib.sha256(edited.encode()).hexdigest()



def test_one_row_and_none(spark, no_docs):
    assert winnowing.compare_with_next(no_docs).collect() == []
    row = winnowing.compare_with_next(documents(spark, [(4, "abc", "", "", 0)])).collect()[0]
    assert (row.near_next, row.edited_sha256) == (1.0, hashlib.sha256(b"aba").hexdigest())


def test_operator_returns_hashes_and_positions(docs, rows):
    found = winnowing.fingerprint_documents(docs).collect()
    expected = sorted(repr((r[0], [int(h) for h in winnowing.winnow(r[1] or "")[0]], winnowing.winnow(r[1] or "")[1].tolist())) for r in rows)
    assert sorted(repr((r.doc_id, r.hashes, r.positions)) for r in found) == expected
    assert base64.b64decode(winnowing.printed(np.array([1], np.uint32))) == b"\1\0\0\0"
