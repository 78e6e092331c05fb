"""Trips and aggregates against plain pandas on random rows."""

import datetime as dt
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetlake.operators.aggregate import trip_aggregate
from fleetlake.operators.chunks import chunk_width, ordered_index, previous_row, run_ids
from fleetlake.operators.median import exact_median
from fleetlake.operators.trips import trip_rows, trip_windows
from fleetlake.schema import AGGREGATIONS
from fleetlake.sources.lake import normalise

DAY = pd.Timestamp("2024-03-01")


def frame(spark, pdf):
    return normalise(spark.createDataFrame(pdf)).withColumn("date", F.col("date").cast("date"))


def random_rows(seed, n=400, devices=3, span=20_000, nulls=0.2):
    rng = np.random.default_rng(seed)
    parts = []
    for d in range(devices):
        seconds = np.sort(rng.choice(span, n, replace=False))
        value = rng.integers(-50, 50, n) / 4.0
        parts.append(
            pd.DataFrame(
                {
                    "device": f"{d:08X}",
                    "date": "2024-03-01",
                    "t": (DAY + pd.to_timedelta(seconds, unit="s")).astype(str),
                    "v": pd.Series(value).where(rng.random(n) >= nulls),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def brute_trips(times, gap, shortest):
    times = sorted(times)
    trips, start = [], times[0]
    for before, now in zip(times, times[1:] + [None]):
        if now is None or now - before > gap:
            if before - start >= shortest:
                trips.append((start, before))
            start = now
    return trips


def spark_value(x):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else x


def test_gap_is_strict_and_minimum_length_inclusive(spark):
    times = ["00:00:00", "00:10:00", "00:20:00.000001", "00:21:00.000001", "01:00:00", "01:00:59"]
    pdf = pd.DataFrame({"device": "A", "date": "2024-03-01", "t": [f"2024-03-01 {t}" for t in times]})
    got = [
        (r.trip_start.isoformat(), r.trip_end.isoformat())
        for r in trip_windows(frame(spark, pdf), "10 min", "1 min").orderBy("trip_start").collect()
    ]
    # A gap of exactly ten minutes stays inside, a microsecond more cuts; exactly one minute is
    # long enough, 59 seconds are not.
    assert got == [
        ("2024-03-01T00:00:00", "2024-03-01T00:10:00"),
        ("2024-03-01T00:20:00.000001", "2024-03-01T00:21:00.000001"),
    ]


@pytest.mark.parametrize("gap", [0, 7, 60, 333])
def test_trips_equal_brute_force(spark, gap):
    pdf = random_rows(gap)
    got = {
        (r.device, r.trip_start, r.trip_end)
        for r in trip_windows(frame(spark, pdf), gap, 0).collect()
    }
    expected = set()
    for device, rows in pdf.groupby("device"):
        times = [t.to_pydatetime() for t in pd.to_datetime(rows["t"])]
        expected |= {(device, a, b) for a, b in brute_trips(times, dt.timedelta(seconds=gap), dt.timedelta(0))}
    assert got == expected


def pandas_value(name, s):
    diff = s.diff()
    return {
        "avg": s.mean,
        "median": s.median,
        "max": s.max,
        "min": s.min,
        "sum": s.sum,
        "first": lambda: s.iloc[0],
        "last": lambda: s.iloc[-1],
        "delta_sum": diff.sum,
        "delta_sum_pos": diff[diff > 0].sum,
        "delta_sum_neg": diff[diff < 0].sum,
    }[name]()


@pytest.mark.parametrize("bucket", ["10 s", "2 min", "1 day"])
def test_aggregates_equal_pandas(spark, bucket):
    pdf = random_rows(3)
    pdf.loc[pdf["device"] == "00000002", "v"] = None
    rows = frame(spark, pdf).cache()
    windows = trip_windows(rows, 90, 60)
    inside = trip_rows(rows, windows, bucket)
    got = {
        (r.device, r.trip_start, r.Aggregation): (spark_value(r.SignalValue), r.SignalCount, r.Duration)
        for r in trip_aggregate(inside, ["v", "none"], [*AGGREGATIONS, "p99"]).collect()
    }
    expected = {}
    for device, part in pdf.groupby("device"):
        t = pd.to_datetime(part["t"])
        trips = brute_trips([x.to_pydatetime() for x in t], dt.timedelta(seconds=90), dt.timedelta(seconds=60))
        for a, b in trips:
            s = part["v"][(t >= a) & (t <= b)].astype(float)
            for name in AGGREGATIONS:
                value = spark_value(float(pandas_value(name, s)))
                expected[device, a, name] = (value, int(s.count()), (b - a).total_seconds())
    assert got.keys() == expected.keys()
    for key, (value, count, duration) in expected.items():
        assert got[key][1:] == (count, duration), key
        assert got[key][0] == (value if value is None else pytest.approx(value, abs=1e-9)), key


def test_delta_of_gaps_is_not_last_minus_first(spark):
    pdf = pd.DataFrame(
        {
            "device": "A",
            "date": "2024-03-01",
            "t": [f"2024-03-01 00:00:0{i}" for i in range(4)],
            "v": [1.0, None, 4.0, 6.0],
        }
    )
    rows = frame(spark, pdf)
    inside = trip_rows(rows, trip_windows(rows, 60), "2 s")
    (row,) = trip_aggregate(inside, ["v"], ["delta_sum"]).collect()
    assert row.SignalValue == 2.0


def test_repeated_aggregation_gives_repeated_rows(spark):
    rows = frame(spark, random_rows(1, n=20, devices=1))
    inside = trip_rows(rows, trip_windows(rows, 10_000), "1 h")
    names = [r.Aggregation for r in trip_aggregate(inside, ["v"], ["max", "max", "median"]).collect()]
    assert sorted(names) == ["max", "max", "median"]


def test_text_signals_are_refused(spark):
    rows = frame(spark, random_rows(1, n=5, devices=1)).withColumn("s", F.lit("x"))
    with pytest.raises(TypeError):
        trip_aggregate(trip_rows(rows, trip_windows(rows, 60)), ["s"], ["max"])


def test_median_of_awkward_values(spark):
    rng = np.random.default_rng(5)
    groups = {
        "one": [3.5],
        "two": [1.0, 2.0],
        "same": [7.0] * 9,
        "signs": [-1e300, -1.0, -1e-300, 0.0, 1e-300, 2.0, 1e300],
        "close": list(1.0 + np.arange(1000) * 1e-15),
        "infinite": [float("-inf"), 1.0, 2.0, float("inf")],
        "random": list(rng.normal(size=2001) * 10.0 ** rng.integers(-3, 6, 2001)),
        "even": list(rng.normal(size=1000)),
    }
    pairs = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("one", None)]
    got = {r.k: r.median for r in exact_median(spark.createDataFrame(pairs, "k string, value double"), ["k"]).collect()}
    assert got == {k: pytest.approx(float(np.median(v)), rel=1e-15) for k, v in groups.items()}


def test_median_of_a_crowd_beside_an_outlier(spark):
    """A million different values within 1e-9: no step may put them in order, and all of them count."""
    n = 1_000_000
    crowd = spark.range(n).select(F.lit("crowd").alias("k"), (F.lit(1.0) + F.col("id") * 1e-15).alias("value"))
    df = crowd.unionAll(spark.createDataFrame([("crowd", 1e18), ("tiny", 5e-324), ("tiny", 1e-323), ("tiny", -1.0)], "k string, value double"))
    got = {r.k: r.median for r in exact_median(df, ["k"]).collect()}
    values = np.sort(np.append(1.0 + np.arange(n) * 1e-15, 1e18))
    assert got == {"crowd": values[n // 2], "tiny": 5e-324}


def test_median_orders_counts_only(spark):
    """Every window runs over cells of a grid, none over values."""
    df = spark.createDataFrame([("a", 1.0)], "k string, value double")
    plan = exact_median(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    ordered = re.findall(r"windowspecdefinition\([^)]*?, (\w+)#\w+ ASC", plan)
    assert ordered and set(ordered) == {"_cell"}


def test_median_with_nan_and_no_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", nan), ("a", 1.0), ("a", 2.0), ("b", nan)], "k string, value double")
    got = {r.k: r.median for r in exact_median(df, ["k"]).collect()}
    assert got["a"] == 2.0 and math.isnan(got["b"])
    assert exact_median(df.limit(0), ["k"]).collect() == []


@pytest.mark.parametrize("width", ["1 s", "100 s", "1 day"])
def test_previous_row_and_runs_do_not_depend_on_chunks(spark, width):
    pdf = random_rows(11)
    rows = frame(spark, pdf).withColumn("flag", F.col("v") > 0)
    prev = {(r.device, r.t): (spark_value(r.prev_v), r.prev_t) for r in previous_row(rows, ["device"], ["v"], width=width).collect()}
    runs = {(r.device, r.t): r.run_id for r in run_ids(rows, ["device"], "flag", width=width).collect()}
    for device, part in pdf.groupby("device"):
        t = [x.to_pydatetime() for x in pd.to_datetime(part["t"])]
        v = [spark_value(float(x)) for x in part["v"]]
        flags = [None if x is None else x > 0 for x in v]
        run = 0
        for i, now in enumerate(t):
            assert prev[device, now] == ((None, None) if i == 0 else (v[i - 1], t[i - 1]))
            run += i == 0 or flags[i] is not flags[i - 1]
            assert runs[device, now] == run


def test_ordered_index_counts_through(spark):
    rows = spark.createDataFrame([(k, c, f) for k in "ab" for c in range(4) for f in range(3)], "k string, c int, f int")
    got = [(r.k, r["index"]) for r in ordered_index(rows, ["k"], ["c"], ["f"]).orderBy("k", "c", "f").collect()]
    assert got == [(k, i) for k in "ab" for i in range(12)]


def test_chunks_get_finer_with_denser_rows(spark):
    rows = spark.range(6000).select(F.lit("A").alias("device"), F.timestamp_seconds(F.col("id") / 10).alias("t"))
    assert chunk_width(rows, ["device"], target_rows=10**9) == 86_400_000_000
    fine = chunk_width(rows, ["device"], target_rows=100)
    assert 1_000_000 < fine <= 10_000_000
