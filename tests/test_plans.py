"""Physical plans of the hot paths."""

import re

import pytest
from pyspark.sql import functions as F

from fleetlake.suite import QUERIES

SF = "/root/testdata/sf0.01"

HOT = [
    "trip_summary",
    "trip_rows",
    "trip_median",
    "trip_delta_sum",
    "event_edges",
    "event_table",
    "event_gps",
    "resample_grid",
    "grid_join",
    "delta_distance",
    "geofence",
    "geofence_many",
    "message_select_all_present",
    "backlog_expand",
    "decode_frames",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HOT)
def test_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_resampling_does_not_sort(spark):
    plan = plan_of(QUERIES["resample_grid"](spark, SF))
    assert "Window" not in plan and "partial_max_by" in plan


def test_grid_join_adds_no_shuffle(spark):
    """The join uses the partitioning that resampling left behind."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["grid_join"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Per message: rows to labels, rows to series ends, series ends to labels.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 2 * 3


def test_thresholds_and_columns_reach_the_scan(spark):
    from fleetlake.operators.edges import detect_edges
    from fleetlake.suite.base import signals

    rows = signals(spark, SF).select("device", "date", "t", "Speed")
    plan = plan_of(detect_edges(rows, "Speed", 20, 60, keys=["device", "date"]))
    assert "LessThanOrEqual(value,20.0)" in plan and "GreaterThanOrEqual(value,60.0)" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_thresholds_reach_the_files_of_a_lake(spark, tmp_path):
    """Through both readers, although missing values are stored as NaN."""
    from fleetlake.plans.event_table import detect_event
    from fleetlake.sources.lake import Lake, write_message, write_path_layout
    from fleetlake.suite.base import signals

    values = F.when(F.col("event_id") % 5 == 0, float("nan")).otherwise(F.col("Speed"))
    rows = signals(spark, SF, 1).where("message = 'view' AND date < '2024-01-03'").select("device", "date", "file_name", "t", values.alias("Speed"))
    write_message(rows, str(tmp_path / "a"), "view")
    write_path_layout(rows, str(tmp_path / "b"), "view")
    event = {
        "event_name": "E", "messages_match_type": "equals", "messages_filtered_list": [["view"]], "trigger_signals": ["Speed"],
        "lower_threshold": 20, "upper_threshold": 60, "rising_as_start": True, "exact_match": False, "raster": "",
    }
    columns = ["t", "EventType", "SignalValue"]
    frame = Lake.of_frame(rows.withColumn("message", F.lit("view")).withColumn("Speed", F.nanvl("Speed", F.lit(None).cast("double"))))
    expected = sorted(map(repr, detect_event(frame, event, width="6 hours").select(*columns).collect()))
    assert expected
    for lake in (Lake.of_folder(spark, str(tmp_path / "a")), Lake.of_path_layout(spark, str(tmp_path / "b"))):
        df = detect_event(lake, event, width="6 hours").select(*columns)
        pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan_of(df))
        assert pushed and all("LessThanOrEqual(Speed,20" in p and "GreaterThanOrEqual(Speed,60" in p for p in pushed)
        assert sorted(map(repr, df.collect())) == expected


def test_series_are_spread_by_time(spark):
    """Rows of one series are never all sent to one task: no row window by series key alone."""
    plan = plan_of(QUERIES["event_edges"](spark, SF))
    windows = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("_chunk" in w for w in windows)


def test_first_notification_needs_no_window(spark):
    from fleetlake.plans.event_table import first_notifications
    from fleetlake.schema import EVENT_SCHEMA

    events = spark.createDataFrame([], EVENT_SCHEMA).withColumn("file_name", F.lit(""))
    assert "Window" not in plan_of(first_notifications(events, ""))


def test_catalogs_are_broadcast_and_frames_are_not(spark):
    plan = plan_of(QUERIES["decode_frames"](spark, SF))
    assert plan.count("BroadcastHashJoin") == 1 and "BuildRight" in plan
    assert "Exchange hashpartitioning" not in plan
