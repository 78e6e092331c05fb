import math

import numpy as np
import pytest

from fleetlake.llm import common, whitening
from fleetlake.llm.whitening import Spectrum, rank_one, secular_roots, whiten


def brute(rows, components=8):
    """Everything by dense algebra on whole numbers."""
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good], dtype=object)
    n, sums = len(x), x.sum(0)
    moved = n * x - sums
    deviation = (moved * moved).sum(1)
    centred = moved.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return [i for i, _ in good], n, deviation, centred @ axes[:, :components] / np.sqrt(values[:components]), values / values.sum()


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", "1 AS slot", "'x' AS vector", "2.5D AS n", "'y' AS component", "CAST(NULL AS int) AS label")


def made(count, width, seed=1):
    rnd = np.random.default_rng(seed)
    spread = np.linspace(3.0, 0.5, width)
    x = rnd.normal(size=(count, width)) * spread @ np.linalg.qr(rnd.normal(size=(width, width)))[0]
    return [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]


def check(spark, rows, **options):
    got = whiten(table(spark, rows), **options).collect()
    ids, n, deviation, whitened, explained = brute(rows)
    k = min(options.get("components", 8), whitened.shape[1])
    assert len(got) == len(ids) * k
    found = {}
    for r in got:
        found.setdefault(r.component, []).append(r)
    for c in range(1, k + 1):
        part = sorted(found[c], key=lambda r: (r.vec_id is not None, r.vec_id or 0, r.whitened))
        order = sorted(range(len(ids)), key=lambda j: (ids[j] is not None, ids[j] or 0))
        assert [r.vec_id for r in part] == [ids[j] for j in order]
        assert {r.n for r in part} == {n}
        assert sorted(r.deviation for r in part) == sorted(int(d) for d in deviation)
        mine, theirs = np.array([r.whitened for r in part]), whitened[order, c - 1]
        if len(set(ids)) == len(ids):
            mine = mine * (np.sign(mine @ theirs) or 1)
            assert np.abs(mine - theirs).max() < 1e-9
        assert abs(part[0].explained - explained[c - 1]) < 1e-12
        assert part[0].identity_error < 1e-10


def test_against_dense_algebra(spark):
    check(spark, made(700, 12))


def test_merging_levels(spark, monkeypatch):
    """Many partitions, so that spectra are combined on several levels."""
    rows = made(300, 9)
    got = whiten(table(spark, rows).repartition(20)).collect()
    assert len(got) == 300 * 8 and max(r.identity_error for r in got) < 1e-10


def test_few_rows_have_few_components(spark):
    rows = made(4, 6)
    got = whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    assert max(r.identity_error for r in got) < 1e-9


def test_copies_and_clusters(spark):
    rows = made(60, 10)
    rows += [(1000 + i, rows[3][1]) for i in range(200)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = made(50, 10)
    bad = [(900, None), (901, [None] * 10), (902, [1.0] * 9 + [float("nan")]), (903, [float("inf")] + [0.0] * 9), (904, []), (905, [1.0, None] + [0.0] * 8)]
    check(spark, rows + bad)
    assert {r.vec_id for r in whiten(table(spark, [*rows, (906, [1.0, 2.0])])).collect()} == {i for i, _ in rows}
    check(spark, [*rows, rows[4], (None, rows[7][1])])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whiten(table(spark, rows)).collect() == []


def test_huge_entries(spark):
    rows = [(i, [float(v * (1e30 if i == 0 else 1)) for v in vec]) for i, vec in made(20, 4)]
    got = whiten(table(spark, rows)).collect()
    assert len(got) == 20 * len({r.component for r in got})
    assert any(r.deviation is None for r in got) and all(math.isfinite(r.whitened) for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_rank_one_updates(seed):
    """Random, clustered and deflated cases keep matrix and orthogonality."""
    rnd = np.random.default_rng(seed)
    width = int(rnd.integers(1, 20))
    values = np.sort(np.repeat(rnd.random(width) * 10.0 ** rnd.integers(-6, 6), 2)[:width])
    if seed % 2:
        values[: width // 2] = 0.0
    vectors = np.linalg.qr(rnd.normal(size=(width, width)))[0]
    for step in range(40):
        change = rnd.normal(size=width) * 10.0 ** rnd.integers(-8, 4)
        if step % 5 == 0:
            change = vectors[:, rnd.integers(width)] * 3
        if step % 7 == 0:
            change[:] = 0
        whole = vectors @ np.diag(values) @ vectors.T + 0.7 * np.outer(change, change)
        values, vectors = rank_one(values, vectors, change, 0.7)
        assert (np.diff(values) >= 0).all()
        assert np.abs(vectors.T @ vectors - np.eye(width)).max() < 1e-12
        assert np.abs(vectors @ np.diag(values) @ vectors.T - whole).max() <= 1e-12 * max(values[-1], 1e-300)


def test_secular_roots_lie_between_the_poles():
    poles, weights = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-12, 2.0, 1e-3, 4.0])
    roots, distance = secular_roots(poles, weights)
    assert (roots[:-1] >= poles[:-1]).all() and (roots[:-1] <= poles[1:]).all() and roots[-1] > 5
    assert np.abs(1 + (weights / distance).sum(1)).max() < 1e-5


def test_spectra_merge():
    rnd = np.random.default_rng(0)
    x = np.round(rnd.normal(size=(200, 7)) * 1000)
    left, right = Spectrum.empty(7), Spectrum.empty(7)
    for v in x[:60]:
        left.add(v, 1)
    for v in x[60:]:
        right.add(v, 2)
    left.merge(right)
    every = np.concatenate([x[:60], x[60:], x[60:]])
    scatter = np.cov(every.T, bias=True) * len(every)
    assert left.count == len(every) and np.allclose(left.mean, every.mean(0))
    assert np.allclose(left.vectors @ np.diag(left.values) @ left.vectors.T, scatter, rtol=1e-11)


def test_combined_is_none_without_rows(spark):
    assert common.combined(spark.createDataFrame([], "total long, slot int"), lambda parts: parts[0]) is None


def test_entries_are_floored(spark):
    rows = [(0, [-0.0001, 0.5]), (1, [0.0001, 0.25]), (2, [0.3, -0.7])]
    vectors, width = whitening.usable(table(spark, rows))
    assert width == 2
    check(spark, rows)
