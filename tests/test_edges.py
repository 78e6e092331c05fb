"""Edge detection against the run definition in pandas, on random series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetlake.operators.edges import detect_edges, edge_memory, merge_memory

START = pd.Timestamp("2024-03-01")


def brute_edges(values, lower, upper, exact=False):
    """``(rising, falling)`` positions by flags, run numbers and first candidate per run."""
    x = pd.Series(values, dtype="float64")
    below = x.eq(lower) if exact else x.le(lower)
    above = x.eq(upper) if exact else x.ge(upper)

    def first_in_runs(hit, run_flag):
        armed = run_flag.cummax().shift(1, fill_value=False)
        run = run_flag.ne(run_flag.shift(1)).cumsum()
        return set(run[hit & armed].drop_duplicates().index)

    return first_in_runs(above, below), first_in_runs(below, above)


def series_frame(spark, series):
    rows = [
        (name, (START + pd.Timedelta(seconds=i)).to_pydatetime(), i, None if v is None else float(v))
        for name, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "device string, t timestamp, i int, x double")


def random_series(seed):
    rng = np.random.default_rng(seed)
    out = {}
    for k in range(40):
        n = int(rng.integers(1, 60))
        values = rng.integers(0, 7, n).astype(object)
        values[rng.random(n) < 0.15] = None
        out[f"s{k}"] = list(values)
    out["nulls"] = [None] * 5
    out["single"] = [6]
    return out


CASES = [(2, 4, False), (3, 3, False), (4, 2, False), (1, 5, True), (3, 3, True), (5, 1, True), (-1, 9, False)]


@pytest.mark.parametrize("lower,upper,exact", CASES)
def test_edges_equal_run_definition(spark, lower, upper, exact):
    series = random_series(abs(lower) * 10 + upper)
    for rising_as_start, width in ((True, "3 s"), (False, "1 day")):
        found = detect_edges(
            series_frame(spark, series), "x", lower, upper, exact, rising_as_start, ["device"], width=width
        ).collect()
        got = {(r.device, r.i, r.EventType, r.EventValue) for r in found}
        expected = set()
        for name, values in series.items():
            rising, falling = brute_edges([np.nan if v is None else v for v in values], lower, upper, exact)
            start, stop = (rising, falling) if rising_as_start else (falling, rising)
            expected |= {(name, i, "Start", 1) for i in start} | {(name, i, "Stop", 0) for i in stop}
        assert got == expected
        assert len(found) == len(got)


def test_starts_and_stops_alternate(spark):
    found = detect_edges(series_frame(spark, random_series(1)), "x", 2, 4, keys=["device"], width="5 s")
    for _, rows in found.toPandas().sort_values("t").groupby("device"):
        kinds = list(rows["EventValue"])
        assert all(a != b for a, b in zip(kinds, kinds[1:]))


@pytest.mark.parametrize("lower,upper,exact", CASES[:3])
def test_memory_stands_for_earlier_rows(spark, lower, upper, exact):
    rows = series_frame(spark, random_series(77))
    keys = ["device"]
    whole = detect_edges(rows, "x", lower, upper, exact, keys=keys)
    memory, parts = None, []
    for lo, hi in ((0, 9), (9, 30), (30, 99)):
        part = rows.where(F.col("i").between(lo, hi - 1))
        parts += detect_edges(part, "x", lower, upper, exact, keys=keys, memory=memory).collect()
        fresh = edge_memory(part, "x", lower, upper, exact, keys)
        memory = fresh if memory is None else merge_memory(memory.unionByName(fresh), keys)
    assert sorted(parts) == sorted(whole.collect())
