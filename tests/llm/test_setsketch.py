import random
import re

import numpy as np
import pytest

from fleetlake.llm import setsketch

from .helpers import documents, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(found) < words:
        return {tuple(found)}
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} if found else set()


def brute(rows, words, percent=80):
    sets = {r[0]: shingles(r[1], words) for r in rows}
    least = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return {i: (len(sets[i]), least[i], least[i] == i) for i in sets}


def found(docs, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in setsketch.link_documents(docs, **options).collect()}


@pytest.mark.parametrize("words", [4, 1])
def test_awkward_rows(unique_docs, unique_rows, words):
    assert found(unique_docs, words=words) == brute(unique_rows, words)


@pytest.mark.parametrize("block", [256, 4])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Chains of edits, a star of edited copies, and texts that share a passage only."""
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rnd = random.Random(11)
    rows, base = [], prose(rnd, 150).split()
    for i in range(60):
        copy = list(base)
        for _ in range(rnd.randint(0, 9)):
            copy[rnd.randrange(len(copy))] = prose(rnd, 1)
        rows.append((500 - i, " ".join(copy), "", "", 0))
    chain = prose(rnd, 120).split()
    for i in range(25):
        chain[i * 4] = f"changed{i}"
        rows.append((600 + i, " ".join(chain), "", "", 0))
    passage = prose(rnd, 60)
    rows += [(700 + i, passage + " " + prose(rnd, rnd.randint(10, 90)), "", "", 0) for i in range(60)]
    expected = brute(rows, 4)
    assert len({e[1] for e in expected.values()}) > 10
    assert found(documents(spark, rows), words=4) == expected


def test_rows_without_id_repeated_rows_and_none(docs, rows, no_docs):
    got = setsketch.link_documents(docs).collect()
    assert len(got) == len(rows)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert setsketch.link_documents(no_docs).collect() == []
    after = setsketch.stage(docs)
    assert after.dtypes == docs.dtypes
    texts = [(r.doc_id, r.text) for r in after.collect() if r.doc_id is not None]
    assert len(texts) == len(set(texts)) and {i for i, _ in texts} >= {r.doc_id for r in got if r.kept and r.doc_id is not None}
    assert setsketch.stage(no_docs).collect() == []


def test_a_repeated_id_names_several_texts(spark):
    """A unique text stays under an id whose other text is a copy, and the copy goes."""
    rnd = random.Random(9)
    first, unique, third = (prose(rnd, 40) for _ in range(3))
    rows = [(1, first), (2, first), (2, unique), (3, third), (3, unique + " x"), (3, third), (4, None), (4, "")]
    after = setsketch.stage(documents(spark, [(i, t, "", "", 0) for i, t in rows]))
    assert sorted((r.doc_id, r.text or "") for r in after.collect()) == sorted([(1, first), (2, unique), (3, third), (4, "")])


def test_shingle_sets_tell_word_borders_apart():
    texts = [b"ab c d e", b"a bc d e", b"A\tB  c", b"a b c", b"", b" \n", b"a", b"A", b"aa", "É é".encode(), "é é".encode()]
    sets = setsketch.shingle_sets(texts, 4)
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0, 1, 1, 1, 1, 1]
    assert np.array_equal(sets[2], sets[3]) and np.array_equal(sets[6], sets[7])
    assert len({int(s[0]) for s in sets if len(s)}) == 7


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(3)
    for common, own in ((900, 50), (500, 500), (0, 800), (4000, 0)):
        values = setsketch._mixed(rnd.integers(0, 1 << 62, common + 2 * own, dtype=np.uint64))
        a, b = values[: common + own], np.r_[values[:common], values[common + own :]]
        x, y = setsketch.registers(a), setsketch.registers(b)
        assert np.array_equal(setsketch.merged(x, y), setsketch.registers(np.union1d(a, b)))
        true = common / (common + 2 * own)
        assert abs(setsketch.estimate(x, y, len(a), len(b))[0] - true) < 5 * (max(true * (1 - true), 0.01) / setsketch.REGISTERS) ** 0.5
        sets = np.unique(a), np.unique(b)
        assert setsketch.similar(sets, (x, y), 80) == (true >= 0.8)


def test_bands_find_pairs_at_the_threshold():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        values = setsketch._mixed(rnd.integers(0, 1 << 62, 120, dtype=np.uint64))
        a, b = values[:108], values[12:]  # 96 of 120: similarity 0.8
        assert set(setsketch.bands(setsketch.registers(a)).tolist()) & set(setsketch.bands(setsketch.registers(b)).tolist())


def test_band_rows_are_shuffled_once(spark, docs, monkeypatch):
    """Most band rows are alone in their bucket: they meet their keys' counts without going through a second exchange."""
    plans, stored = {}, setsketch.stored

    def watched(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(setsketch, "stored", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        setsketch.link_documents(docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(key", plans["buckets"])) == 1


def test_many_pairs_are_estimated_at_once(monkeypatch):
    """Pairs of all similarities: the same answers as from their sets, for a fixed number of steps of the likelihood."""
    rnd = np.random.default_rng(6)
    calls, likelihood = [], setsketch.log_likelihood
    monkeypatch.setattr(setsketch, "log_likelihood", lambda *a: calls.append(1) or likelihood(*a))
    pairs = []
    for k in range(300):
        values = np.unique(setsketch._mixed(rnd.integers(0, 1 << 62, 400 + k, dtype=np.uint64)))
        cut = int(rnd.integers(0, len(values) // 2))
        pairs.append((values[: len(values) - cut // 2], values[cut - cut // 2 :]))
    x, y = (setsketch.registers_of([p[side] for p in pairs]) for side in (0, 1))
    assert np.array_equal(x, np.stack([setsketch.registers(p[0]) for p in pairs]))
    found = setsketch.similar_pairs(pairs, x, y, 80)
    assert len(calls) < 100
    both = [len(np.intersect1d(*p)) for p in pairs]
    expected = [100 * c >= 80 * (len(a) + len(b) - c) for c, (a, b) in zip(both, pairs, strict=True)]
    assert found.tolist() == expected and 50 < sum(expected) < 250
    assert setsketch.similar_pairs([], x[:0], y[:0], 80).tolist() == []


def test_blocks_of_sets_are_counted_by_products(monkeypatch):
    monkeypatch.setattr(setsketch, "COUNTED", 50)
    rnd = np.random.default_rng(7)
    a, b = ([np.unique(rnd.integers(0, 700, rnd.integers(1, 300)).astype(np.uint64) << np.uint64(55)) for _ in range(n)] for n in (23, 31))
    expected = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert setsketch.common_counts(a, b).tolist() == expected
    apart = [np.array([1], np.uint64)], [np.array([2, 3], np.uint64)]
    assert setsketch.common_counts(*apart).tolist() == [[0]]
