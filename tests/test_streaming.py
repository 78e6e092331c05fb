"""Streams end up with what the batch jobs give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.edges import detect_edges
from fleetlake.plans.custom_messages import custom_messages
from fleetlake.plans.event_table import event_table, first_notifications
from fleetlake.session import work_folder
from fleetlake.sources.configs import events_config
from fleetlake.sources.lake import Lake, read_lake, write_path_layout
from fleetlake.streaming.detector import EdgeDetector
from fleetlake.streaming.incremental import (
    Incremental,
    drain,
    latest,
    run_incremental,
    run_whole_files,
    stream_files,
    stream_lake,
    with_derived,
)
from fleetlake.suite.streams import CUSTOM, EVENTS
from fleetlake.suite.base import as_signals
from fleetlake.operators.custom import CustomContext
from fleetlake.suite.grid import FENCES

from .test_lake import at, path_lake  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def day_files(spark):
    """The events table as one file per day, handed out one per batch."""
    folder = work_folder(spark, "days")
    events = spark.read.parquet(f"{SF}/events.parquet")
    days = events.withColumn("d", F.to_date("ts")).select("d").distinct().orderBy("d").limit(5).collect()
    for n, row in enumerate(days):
        events.where(F.to_date("ts") == row.d).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.read.parquet(folder)


def test_incremental_events_equal_batch(spark, day_files):
    folder, events = day_files
    out = work_folder(spark, "incremental")
    general, configured = events_config(EVENTS)
    context = CustomContext(fences=FENCES)
    delivered = []
    job = Incremental(CUSTOM, general, configured, f"{out}/lake", f"{out}/events", context, deliver=delivered.extend)
    stream = as_signals(stream_files(spark, folder, events.schema, files_per_batch=1))
    run_incremental(stream, job, f"{out}/checkpoint")
    # A second run finds nothing new.
    run_incremental(stream, job, f"{out}/checkpoint")

    lake = Lake.of_frame(as_signals(events))
    derived = custom_messages(lake, CUSTOM, context)
    columns = ["t", "EventName", "DeviceID", "Message", "Signal", "EventType", "SignalValue", "file_name"]
    table = event_table(spark, with_derived(lake, derived), general, configured)
    expected = table.select(*columns)
    found = spark.read.parquet(f"{out}/events")
    assert sorted(found.select(*columns).collect()) == sorted(expected.collect())
    stored = read_lake(spark, f"{out}/lake")
    assert stored.count() == derived["Fences"].count()
    assert stored.select("batch_id").distinct().count() > 1
    # One notice per event and batch; the first one is the notice of the batch job.
    first = min(delivered, key=lambda n: n.t)
    (whole,) = first_notifications(table, general["static_body_content"]).collect()
    assert (first.subject, first.body) == (whole.subject, whole.body)


def test_a_repeated_batch_changes_nothing(spark, day_files):
    _, events = day_files
    out = work_folder(spark, "repeat")
    general, configured = events_config(EVENTS)
    job = Incremental(CUSTOM, general, configured, f"{out}/lake", f"{out}/events", CustomContext(fences=FENCES))
    rows = as_signals(events)
    job(rows, 0)
    before = sorted(map(str, spark.read.parquet(f"{out}/events").collect()))
    job(rows, 0)
    assert sorted(map(str, spark.read.parquet(f"{out}/events").collect())) == before


def test_detector_goes_on_across_batches(spark, day_files):
    folder, events = day_files
    rows = as_signals(events)
    out = work_folder(spark, "detector")
    stream = as_signals(stream_files(spark, folder, events.schema, files_per_batch=1))
    found = EdgeDetector(out, "Speed", 20, 60, keys=["device"]).run(stream, f"{out}/checkpoint")
    expected = detect_edges(rows, "Speed", 20, 60, keys=["device"])
    columns = ["device", "t", "EventType"]
    assert sorted(found.select(*columns).collect()) == sorted(expected.select(*columns).collect())
    by_day = detect_edges(rows, "Speed", 20, 60, keys=["device", "date"])
    assert by_day.count() < expected.count()


def test_path_layout_stream(spark, path_lake):  # noqa: F811
    schema = "t timestamp_ntz, v double"
    from pyspark.sql.types import _parse_datatype_string

    seen = []
    stream = stream_lake(spark, f"{path_lake}/0000000A", _parse_datatype_string(schema))
    drain(stream, lambda df, n: seen.extend(df.collect()), work_folder(spark, "checkpoint"))
    speeds = [r for r in seen if r.message == "Speed"]
    assert {(r.device, r.date, r.file_name, r.v) for r in speeds if r.date == dt.date(2024, 3, 1)} == {
        ("0000000A", dt.date(2024, 3, 1), "1.parquet", 1.0),
        ("0000000A", dt.date(2024, 3, 1), "1.parquet", None),
    }


WHOLE = [
    {
        "custom_message_name": "Joined",
        "messages_match_type": "equals",
        "messages_filtered_list": [["click", "view"]],
        "raster": "6h",
        "prefix": True,
        "function": "resample",
    }
]
WHOLE_EVENTS = {
    "general": {"include_gps_data": True, "signal_latitude": "Lat", "signal_longitude": "Lon", "messages_gps": ["place"]},
    "events": [
        {
            "event_name": "Busy",
            "messages_match_type": "equals",
            "messages_filtered_list": [["click"]],
            "trigger_signals": ["Speed"],
            "lower_threshold": 30,
            "upper_threshold": 50,
            "rising_as_start": True,
            "exact_match": False,
            "raster": "6h",
        }
    ],
}


@pytest.fixture(scope="module")
def small_lake(spark):
    """A path-layout lake of three messages over a few days, written by the library."""
    root = work_folder(spark, "small-lake")
    rows = as_signals(spark.read.parquet(f"{SF}/events.parquet"), 2).where(F.col("date") < dt.date(2024, 1, 3))
    columns = ["device", "date", "file_name", "t", "message"]
    rows = rows.withColumn("file_name", F.lit("day.parquet"))
    assert write_path_layout(rows.where("message = 'click'").select(*columns, "Speed"), root) > 1
    write_path_layout(rows.where("message = 'view'").select(*columns, "K"), root)
    write_path_layout(rows.select(*columns, F.col("Latitude").alias("Lat"), F.col("Longitude").alias("Lon")).withColumn("message", F.lit("place")), root)
    return root


@pytest.mark.parametrize("per_batch", [1, 3, 1000])
def test_whole_files_give_the_same_in_any_batches(spark, small_lake, per_batch):
    out = work_folder(spark, "whole")
    general, events = events_config(WHOLE_EVENTS)
    job = Incremental(WHOLE, general, events, f"{out}/lake", f"{out}/events")
    run_whole_files(spark, small_lake, job, f"{out}/checkpoint", per_batch)

    lake = Lake.of_path_layout(spark, small_lake)
    derived = custom_messages(lake, WHOLE)
    columns = ["device", "date", "file_name", "t", "click_Speed", "view_K"]
    found = latest(spark, f"{out}/lake", "Joined").select(*columns).collect()
    assert found and sorted(map(repr, found)) == sorted(map(repr, derived["Joined"].select(*columns).collect()))
    columns = ["t", "EventName", "DeviceID", "EventType", "SignalValue", "Latitude", "Longitude", "file_name"]
    expected = event_table(spark, lake, general, events).select(*columns).collect()
    found = latest(spark, f"{out}/events").select(*columns).collect()
    assert found and sorted(map(repr, found)) == sorted(map(repr, expected))


def test_a_late_message_revises_its_log_file(spark, tmp_path):
    def put(message, day, values):
        rows = [("A", day, "1.parquet", dt.datetime(2024, 1, int(day[-2:]), h), v) for h, v in values]
        df = spark.createDataFrame(rows, "device string, date string, file_name string, t timestamp, Speed double")
        write_path_layout(df.withColumn("date", F.to_date("date")), str(tmp_path / "in"), message)

    events = [{**WHOLE_EVENTS["events"][0], "raster": ""}]
    custom = [{**WHOLE[0], "raster": "1h"}]
    general, events = events_config({"general": {"include_gps_data": False}, "events": events})
    out = str(tmp_path / "out")
    job = Incremental(custom, general, events, f"{out}/lake", f"{out}/events")
    put("click", "2024-01-01", [(1, 10.0), (2, 90.0)])
    run_whole_files(spark, str(tmp_path / "in"), job, f"{out}/checkpoint")
    assert latest(spark, f"{out}/lake", "Joined") is None
    assert latest(spark, f"{out}/events").count() == 1
    put("view", "2024-01-01", [(1, 1.0), (2, 2.0)])
    put("click", "2024-01-02", [(1, 10.0), (2, 20.0)])
    run_whole_files(spark, str(tmp_path / "in"), job, f"{out}/checkpoint")
    joined = latest(spark, f"{out}/lake", "Joined").collect()
    assert joined and {r.date for r in joined} == {dt.date(2024, 1, 1)}
    assert latest(spark, f"{out}/events").count() == 1
