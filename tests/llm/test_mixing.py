import hashlib
import re
from collections import defaultdict

import pytest

from fleetlake.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights, share, repeats):
    """By raising the level little by little over the saturation points."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(repeats * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        if not total:
            return {s: float(repeats * sizes[s]) for s in names}
        over = {s for s in names if s not in full and rest * weight[s] / total >= repeats * sizes[s]}
        if not over:
            return {s: float(repeats * sizes[s]) if s in full else rest * weight[s] / total for s in names}
        full |= over


def check(found, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    expected = targets(sizes, (3, 1, 2), 1.5, 2)
    assert sorted((repr((r[0], words(r[1]), sizes[r[3]])) for r in rows)) == sorted(repr((r.doc_id, r.size, r.source_size)) for r in found)
    source_of = {(r[0], words(r[1])): r[3] for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        source = source_of[r.doc_id, r.size]
        assert r.target == pytest.approx(expected[source])
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for s, t in expected.items():
        assert abs(taken[s] - t) <= largest[s] + 1


def test_targets_and_shares(docs, rows):
    found = mixing.mix_sources(docs).collect()
    check(found, rows)
    assert sorted(map(repr, mixing.mix_sources(docs.repartition(5)).collect())) == sorted(map(repr, found))


def test_even_documents_meet_their_targets(spark):
    rows = [(i, "one two three four", "en", f"s{i % 7}" if i % 3 else "s0", 18) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix_sources(docs).collect()
    check(found, rows)
    assert abs(sum(r.taken for r in found) - 1.5 * 8000) <= 4


def test_order_is_that_of_the_digests(spark):
    rows = [(i, "w " * (1 + i % 5), "x") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    order = sorted(found, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    copies = [found[i].copies for i in order]
    assert copies == sorted(copies, reverse=True) and set(copies) == {1, 2}


def test_nothing_to_mix(spark, no_docs):
    assert mixing.mix_sources(no_docs).collect() == []
    assert mixing.stage(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.taken) for r in mixing.mix_sources(blank).collect()] == [(0, 0), (0, 0)]


def test_stage_repeats_rows(docs, rows):
    after = mixing.stage(docs)
    assert after.dtypes == docs.dtypes
    taken = sum(words(r.text) for r in after.collect())
    assert taken == sum(r.taken for r in mixing.mix_sources(docs).collect())
    known = {repr((r[0], r[1])) for r in rows}
    assert all(repr((r.doc_id, r.text)) in known for r in after.collect())
