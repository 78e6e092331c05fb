import math
import random

import numpy as np
import pytest

from fleetlake.llm import components as component_steps
from fleetlake.llm import near_vectors
from fleetlake.llm.components import components


def brute(rows, cosine):
    """Links and least reachable id by comparing all pairs."""
    good = {i: np.array(v, np.float64) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    links = {i: 0 for i, _ in rows}
    least = {i: i for i, _ in rows}
    pairs = []
    for a in ids:
        for b in ids:
            if a != b and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= cosine:
                links[a] += 1
                pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if least[b] < least[a]:
                least[a] = least[b]
                changed = True
    return {i: (links[i], least[i], least[i] == i) for i, _ in rows}


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", "1 AS id", "'x' AS k1", "2.5D AS n", "'y' AS block")


def found(spark, rows, **options):
    got = near_vectors.link_vectors(table(spark, rows), **options).collect()
    assert len(got) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def clustered(count, width, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, width))
    rows = []
    for i in range(count):
        spread = rnd.choice([0.0, 0.02, 0.1, 0.25, 1.0])
        v = (centres[rnd.integers(12)] + spread * rnd.normal(size=width)) * rnd.choice([1, 3, 1e-3])
        rows.append((int(i * 7 % (count * 7 + 1)), [float(x) for x in v.astype(np.float32)]))
    return rows


@pytest.mark.parametrize("width", [3, 16])
def test_clusters(spark, monkeypatch, width):
    """Small intervals and leaves, so that pairs of intervals, halving and whole links all occur."""
    monkeypatch.setattr(near_vectors, "INTERVAL", 40)
    monkeypatch.setattr(near_vectors, "LEAF", 8)
    rows = clustered(300, width, width)
    rows += [(10_000 + i, rows[0][1]) for i in range(60)]
    rows += [(20_000 + i, [x * (1 + 1e-4 * i) + 1e-5 * ((i * k) % 5) for k, x in enumerate(rows[1][1])]) for i in range(150)]
    expected = brute(rows, 0.95)
    assert max(e[0] for e in expected.values()) > 100
    assert found(spark, rows) == expected


@pytest.mark.parametrize("shipped", [0.0, 1e9])
def test_intervals_meet_without_a_shuffle_unless_few_do(spark, monkeypatch, tmp_path, shipped):
    """Vectors in all directions, so that all intervals meet: read in pairs, or joined where few are said to meet."""
    monkeypatch.setattr(near_vectors, "INTERVAL", 200)
    monkeypatch.setattr(near_vectors, "LEAF", 16)
    monkeypatch.setattr(near_vectors, "PENDING", 10)
    monkeypatch.setattr(near_vectors, "SHIPPED", shipped)
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(3000, 40))
    x[1000:1200] = x[:200] + 0.2 * rnd.normal(size=(200, 40))
    x[2000:2150] = x[5] + 0.05 * rnd.normal(size=(150, 40))
    x[2500:2600] = x[6] + 0.22 * rnd.normal(size=(100, 40))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(np.float32).tolist())], "vec_id long, embedding array<float>").repartition(4)
    df.write.parquet(str(tmp_path / "in"))
    result = near_vectors.link_vectors(spark.read.parquet(str(tmp_path / "in")))
    u = x.astype(np.float32).astype(np.float64)
    u /= np.sqrt((u * u).sum(1))[:, None]
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    least = np.arange(len(u))
    while (lower := np.array([min(least[i], least[row].min(initial=i)) for i, row in enumerate(links)])).tolist() != least.tolist():
        least = lower
    assert links.sum() > 20_000
    assert {r.vec_id: (r.n_links, r.component_id) for r in result.collect()} == {i: (int(n), int(c)) for i, (n, c) in enumerate(zip(links.sum(1), least, strict=True))}


def test_pairs_of_intervals_are_not_shuffled(spark, monkeypatch, tmp_path):
    """Where all intervals meet, their packed vectors pass no exchange on the way to the comparison."""
    plans, stored = {}, near_vectors.stored

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label)

    monkeypatch.setattr(near_vectors, "stored", watched)
    monkeypatch.setattr(near_vectors, "INTERVAL", 100)
    x = np.random.default_rng(4).normal(size=(1000, 64)).astype(np.float32)
    spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        near_vectors.link_vectors(spark.read.parquet(str(tmp_path / "in")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Each partition is read with each other one, in place of joins on the numbers of the intervals.
    pairs = next(part for part in plans["links"].split("MapInArrow") if "ids2" in part)
    assert "CartesianProduct" in pairs and "Exchange" not in pairs.partition("CartesianProduct")[0]


def test_bad_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (4, [2.0, 0.0]), (3, None), (2, []), (1, [0.0, 0.0]), (0, [nan, 1.0]), (-1, [inf, 1.0]), (-2, [None, 1.0])]
    rows += [(6, None), (7, [0.0, 0.0]), (8, [1.0]), (9, [3e38, 0.0]), (10, [1e-38, 0.0])]
    got = found(spark, rows)
    assert {i: got[i] for i in (3, 2, 1, 0, -1, -2, 6, 7)} == {i: (0, i, True) for i in (3, 2, 1, 0, -1, -2, 6, 7)}
    # Shorter vectors count as filled up with zeros; length doesn't matter.
    assert all(got[i] == (4, 4, i == 4) for i in (4, 5, 8, 9, 10))


def test_only_bad_vectors_and_none(spark):
    assert found(spark, [(1, None), (2, [0.0])]) == {1: (0, 1, True), 2: (0, 2, True)}
    assert near_vectors.link_vectors(table(spark, [(1, None)]).limit(0)).collect() == []


def test_missing_ids_and_repeated_rows(spark):
    got = near_vectors.link_vectors(table(spark, [(None, [1.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (None, None)])).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == [(3, 2, 3), (3, 2, 3), (None, 0, None), (None, 2, 3)]


@pytest.mark.parametrize("few", [0, 200_000])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, few):
    monkeypatch.setattr(component_steps, "FEW_EDGES", few)
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 300)]
    edges += [(rnd.randint(1000, 1400), rnd.randint(1000, 1400)) for _ in range(250)]
    rnd.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges for x in (a, b) if a != b}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
