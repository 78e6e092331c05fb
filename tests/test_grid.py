"""Resampling against pandas, joins, positions and fences."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetlake.functions.geo import haversine, with_fence
from fleetlake.functions.timegrid import duration_us, raster_us
from fleetlake.operators.custom import CustomContext, apply_custom, register_custom
from fleetlake.operators.resample import resample_grid, with_position
from fleetlake.plans.custom_messages import custom_message
from fleetlake.sources.lake import Lake

KEYS = ["device"]


def pandas_grid(pdf, raster):
    grid = pdf.set_index("t").resample(raster).ffill(limit=1)
    grid.index = grid.index.round(raster)
    return grid.dropna(how="all")


@pytest.mark.parametrize("raster", ["0.2s", "1s", "5s", "60s"])
def test_resample_equals_pandas(spark, raster):
    rng = np.random.default_rng(int(float(raster[:-1]) * 10))
    parts = []
    for d in range(30):
        n = int(rng.integers(1, 40))
        step = 100 if d % 2 else 50
        ms = np.sort(rng.choice(4000, n, replace=False)) * step
        parts.append(
            pd.DataFrame(
                {
                    "device": f"d{d}",
                    "t": pd.Timestamp("2024-03-01 23:59:00") + pd.to_timedelta(ms, unit="ms"),
                    "a": pd.Series(rng.normal(size=n)).where(rng.random(n) > 0.3),
                    "b": pd.Series(rng.normal(size=n)).where(rng.random(n) > 0.3),
                }
            )
        )
    pdf = pd.concat(parts, ignore_index=True)
    rows = spark.createDataFrame(pdf).withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in "ab"})
    got = resample_grid(rows, raster, keys=KEYS).toPandas()
    expected = pd.concat(
        [pandas_grid(p.drop(columns="device"), raster).assign(device=d) for d, p in pdf.groupby("device")]
    ).reset_index()
    order = ["device", "t"]
    pd.testing.assert_frame_equal(
        got[["device", "t", "a", "b"]].sort_values(order, ignore_index=True),
        expected[["device", "t", "a", "b"]].sort_values(order, ignore_index=True),
        check_dtype=False,
        check_freq=False,
    )


def test_equal_times_keep_one_row_and_lonely_rows_give_nothing(spark):
    t = dt.datetime(2024, 3, 1, 0, 0, 1, 500_000)
    rows = spark.createDataFrame(
        [("two", t, 1.0), ("two", t, 2.0), ("two", t + dt.timedelta(seconds=3), 3.0), ("lonely", t, 1.0)],
        "device string, t timestamp, a double",
    )
    got = resample_grid(rows, "1s", keys=KEYS).collect()
    assert [(r.device, r.t.second) for r in got] == [("two", 2)]


def test_rasters_must_divide_a_day():
    assert raster_us("0.2s") == 200_000
    assert duration_us("15 min") == duration_us("15min") == 900_000_000
    assert duration_us("minute") == 60_000_000
    for bad in ("0.7s", "0s", "7h"):
        with pytest.raises(ValueError):
            raster_us(bad)
    with pytest.raises(ValueError):
        duration_us("soon")


def at(seconds):
    return dt.datetime(2024, 3, 1) + dt.timedelta(seconds=seconds)


def test_position_comes_from_the_first_message_a_file_has(spark):
    keys = ["file"]
    grid = spark.createDataFrame(
        [(f, at(s), float(s)) for f in ("both", "second", "none") for s in range(3)],
        "file string, t timestamp, v double",
    )
    schema = "file string, t timestamp, Latitude double, Longitude double"
    first = spark.createDataFrame([("both", at(0), 1.0, 1.0), ("both", at(1), 1.5, None)], schema)
    second = spark.createDataFrame([("both", at(2), 9.0, 9.0), ("second", at(2), 2.0, 2.0)], schema)
    got = with_position(grid, [(first, first), (second, second)], keys).collect()
    assert sorted((r.file, r.t.second, r.Latitude, r.Longitude) for r in got if r.file != "none") == [
        ("both", 0, 1.0, 1.0),
        ("both", 1, 1.5, None),
        ("second", 2, 2.0, 2.0),
    ]
    assert [(r.Latitude, r.Longitude) for r in got if r.file == "none"] == [(None, None)] * 3


def distance(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


@pytest.mark.parametrize("count", [0, 5, 300])
def test_first_fence_in_list_order(spark, count):
    rng = random.Random(count)
    fences = [
        {
            "id": 100 + i,
            "latitude": rng.choice([rng.uniform(-90, 90), 89.9, -89.95, rng.uniform(55, 56)]),
            "longitude": rng.choice([rng.uniform(-180, 180), 179.99, -179.99, rng.uniform(9, 10)]),
            "radius": rng.choice([rng.uniform(0, 5), rng.uniform(5, 400)]),
        }
        for i in range(count)
    ]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(rng.uniform(55, 56), rng.uniform(9, 10)) for _ in range(300)]
    points += [(89.99, rng.uniform(-180, 180)) for _ in range(50)] + [(rng.uniform(-1, 1), 180.0), (0.0, -180.0)]
    points += [(f["latitude"], f["longitude"] + 0.001) for f in fences]
    rows = [(i, *p) for i, p in enumerate(points)] + [(-1, None, 1.0), (-2, 1.0, None)]
    df = spark.createDataFrame(rows, "i int, Latitude double, Longitude double")
    got = {r.i: r.GeofenceId for r in with_fence(df, fences).collect()}
    assert len(got) == len(rows)
    for i, lat, lon in rows:
        hit = None
        if lat is not None and lon is not None:
            hit = next(
                (f["id"] for f in fences if distance(lat, lon, f["latitude"], f["longitude"]) <= f["radius"]), None
            )
        assert got[i] == (hit or 0), (i, lat, lon)


def test_haversine_of_a_degree(spark):
    (row,) = spark.range(1).select(haversine(*map(F.lit, (0.0, 0.0, 0.0, 1.0))).alias("km")).collect()
    assert row.km == pytest.approx(6371.0 * math.pi / 180)


def test_unknown_custom_function_changes_nothing_but_the_tag(spark):
    df = spark.createDataFrame([("m", 1)], "Message string, x int")
    assert apply_custom(df, "no such function").columns == ["x"]


def test_own_custom_functions_can_be_registered(spark):
    @register_custom("double_x")
    def double_x(df, context):
        return df.withColumn("x", F.col("x") * 2)

    df = spark.createDataFrame([("m", 1)], "Message string, x int")
    assert apply_custom(df, "double_x", CustomContext()).collect() == [(2,)]


def lake_rows(spark):
    rows = [
        (d, m, dt.date(2024, 3, 1), f, at(s), float(s), s % 3)
        for d, f, ms in (("A", "1", "xyz"), ("A", "2", "xy"), ("B", "1", "x"))
        for m in ms
        for s in range(4)
    ]
    return spark.createDataFrame(
        rows, "device string, message string, date date, file_name string, t timestamp, v double, k int"
    )


@pytest.mark.parametrize(
    "config,files",
    [
        ({"messages_match_type": "equals", "messages_filtered_list": [["x", "y"]], "raster": "1s"}, {("A", "1"), ("A", "2")}),
        ({"messages_match_type": "equals", "messages_filtered_list": [["x", "z"], ["y"]], "raster": ""}, {("A", "1"), ("A", "2")}),
        ({"messages_match_type": "contains", "messages_filtered_list": "x", "raster": ""}, {("A", "1"), ("A", "2"), ("B", "1")}),
        ({"messages_match_type": "all_messages", "raster": "1s"}, {("A", "1"), ("A", "2"), ("B", "1")}),
        ({"messages_match_type": "all_messages", "raster": ""}, {("A", "1"), ("A", "2"), ("B", "1")}),
        ({"messages_match_type": "equals", "messages_filtered_list": [["x", "absent"]], "raster": ""}, set()),
    ],
)
def test_custom_message_inputs(spark, config, files):
    prefix = config["messages_match_type"] == "all_messages" and bool(config["raster"]) or config["raster"] == "1s"
    config = {"custom_message_name": "c", "function": "resample", "prefix": prefix, **config}
    result = custom_message(Lake.of_frame(lake_rows(spark)), config)
    assert "Message" not in result.columns
    assert {(r.device, r.file_name) for r in result.collect()} == files


def test_joined_messages_need_distinct_names(spark):
    config = {"custom_message_name": "c", "function": "resample", "prefix": False, "messages_match_type": "all_messages", "raster": "1s"}
    with pytest.raises(ValueError):
        custom_message(Lake.of_frame(lake_rows(spark)), config)
