"""Lake layouts, sinks, listings, configs and triggers."""

import datetime as dt
import json
import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.paths import as_prefix, device_of, forward_slashes, stored_name
from fleetlake.operators.select import file_groups, select_messages
from fleetlake.plans.custom_messages import custom_message, write_custom_messages
from fleetlake.plans.event_table import event_table, first_notifications
from fleetlake.plans.trip_summary import days_processed, trip_summary
from fleetlake.schema import EVENT_SCHEMA, TRIP_SUMMARY_SCHEMA
from fleetlake.session import work_folder
from fleetlake.sources import configs
from fleetlake.sources import lake as lake_module
from fleetlake.sources.lake import (
    Lake,
    PublishedNothing,
    publish,
    read_lake,
    read_path_layout,
    write_events,
    write_message,
    write_path_layout,
    write_trip_summary,
)
from fleetlake.sources.objects import list_objects, log_files, with_lake_parts
from fleetlake.sources.triggers import trigger_paths
from fleetlake.streaming.incremental import Incremental, latest, run_whole_files

DAY = dt.date(2024, 3, 1)


def at(seconds, day=DAY):
    return dt.datetime.combine(day, dt.time()) + dt.timedelta(seconds=seconds)


def write_file(root, device, message, day, name, **columns):
    folder = root / device / message / day.strftime("%Y/%m/%d")
    folder.mkdir(parents=True, exist_ok=True)
    arrays = {k: pa.array(v, pa.timestamp("us") if k == "t" else None) for k, v in columns.items()}
    pq.write_table(pa.table(arrays), folder / name)


@pytest.fixture()
def path_lake(tmp_path):
    nan = float("nan")
    for day in (DAY, DAY + dt.timedelta(1)):
        write_file(tmp_path, "0000000A", "Speed", day, "1.parquet", t=[at(0, day), at(1, day)], v=[1.0, nan])
        write_file(tmp_path, "0000000B", "Speed", day, "1.parquet", t=[at(0, day)], v=[2.0], w=[7])
    write_file(tmp_path, "0000000A", "Pos", DAY, "1.parquet", t=[at(0)], lat=[3.0])
    return tmp_path


def test_path_layout_gives_columns_and_nulls(spark, path_lake):
    rows = read_path_layout(spark, str(path_lake), ["Speed"], drift=True)
    assert dict(rows.dtypes)["t"] == "timestamp"
    got = sorted((r.device, r.message, r.date.day, r.file_name, r.v, r.w) for r in rows.where("date = '2024-03-01'").fillna({"v": -1.0, "w": -1}).collect())
    assert got == [
        ("0000000A", "Speed", 1, "1.parquet", -1.0, -1),
        ("0000000A", "Speed", 1, "1.parquet", 1.0, -1),
        ("0000000B", "Speed", 1, "1.parquet", 2.0, 7),
    ]


def test_path_layout_reads_only_wanted_folders(spark, path_lake):
    rows = read_path_layout(spark, str(path_lake), ["Speed"], ["0000000A"], [DAY, DAY + dt.timedelta(9)])
    assert len(rows.inputFiles()) == 1
    assert read_path_layout(spark, str(path_lake), ["Speed"], None, [dt.date(2020, 1, 1)]).count() == 0


def test_listing_is_relative_and_case_sensitive(spark, path_lake):
    listed = list_objects(spark, str(path_lake), "0000000A/", ".parquet")
    paths = {r.path for r in listed.collect()}
    assert paths == {
        "0000000A/Speed/2024/03/01/1.parquet",
        "0000000A/Speed/2024/03/02/1.parquet",
        "0000000A/Pos/2024/03/01/1.parquet",
    }
    assert list_objects(spark, str(path_lake), "0000000a/").count() == 0
    assert all(r.size > 0 and r.last_modified for r in listed.collect())
    groups = {(r.device, r.date.day): r.messages for r in file_groups(with_lake_parts(listed)).collect()}
    assert groups == {("0000000A", 1): ["Pos", "Speed"], ("0000000A", 2): ["Speed"]}


def test_log_files(spark):
    names = spark.createDataFrame([("a/b/c.MF4",), ("a/b/c.mfm",), ("a/b/c.mf5",), ("a/b/mf4",)], "path string")
    assert [r.path for r in log_files(names).collect()] == ["a/b/c.MF4", "a/b/c.mfm"]


def signals(spark, days=(DAY,), devices=("00000001", "0000000E")):
    rows = [(d, "Speed", day, "f", at(s, day), float(s)) for d in devices for day in days for s in range(0, 7200, 600)]
    return spark.createDataFrame(rows, "device string, message string, date date, file_name string, t timestamp, v double")


def test_message_sink_round_trip_and_pruning(spark):
    root = work_folder(spark, "lake")
    rows = signals(spark, (DAY, DAY + dt.timedelta(1)))
    write_message(rows, root)
    write_message(rows.select("device", "date", "file_name", "t", (F.col("v") * 2).alias("w")), root, "Double")
    lake = Lake.of_folder(spark, root)
    assert lake.names() == ["Double", "Speed"]
    assert lake.message("Absent") is None
    back = lake.message("Speed")
    # Leading zeros of device ids survive, and signals of other messages do not appear.
    assert sorted(back.columns) == sorted(rows.columns)
    assert sorted(back.select(*rows.columns).collect()) == sorted(rows.collect())
    pruned = read_lake(spark, root).where((F.col("device") == "00000001") & (F.col("date") == F.lit(DAY)))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "device" in partition_filters and "date" in partition_filters


def test_files_are_written_in_time_order(spark):
    root = work_folder(spark, "ordered")
    write_message(signals(spark).orderBy(F.col("t").desc()), root)
    for path in read_lake(spark, root).inputFiles():
        times = [r.t for r in spark.read.parquet(path).collect()]
        assert times == sorted(times) and len(times) > 1


def test_rerun_replaces_only_its_days(spark):
    root = work_folder(spark, "tripsummary")
    next_day = DAY + dt.timedelta(1)

    def day_rows(day, value):
        rows = [("A", "m", "s", "max", value, 1, 0.0, at(0, day), at(9, day), "id", "c", day)]
        return spark.createDataFrame(rows, T.StructType([*TRIP_SUMMARY_SCHEMA, T.StructField("date", T.DateType())]))

    write_trip_summary(day_rows(DAY, 1.0).unionByName(day_rows(next_day, 1.0)), root)
    write_trip_summary(day_rows(next_day, 2.0), root)
    got = {(r.date, r.SignalValue) for r in spark.read.parquet(root).collect()}
    assert got == {(DAY, 1.0), (next_day, 2.0)}


def test_publish_counts_and_refuses_nothing(spark):
    rows = signals(spark)
    assert publish(rows, work_folder(spark, "out"), ["device"]) == rows.count()
    with pytest.raises(PublishedNothing):
        publish(rows.where("v < 0"), work_folder(spark, "out"), ["device"])


# --- configs ------------------------------------------------------------------------------


def aggregation_document(**date):
    return {
        "config": {"date": date, "trip": {"trip_gap_min": 10, "trip_min_length_min": 1}},
        "device_clusters": [
            {"devices": ["00000001", "0000000E"], "cluster": "one"},
            {"devices": ["0000000E"], "cluster": "two"},
            {"devices": ["0000000E"], "cluster": "lost"},
        ],
        "cluster_details": [
            {"clusters": ["one", "two"], "details": {"trip_identifier": {"message": "Speed"}, "aggregations": [{"message": "Speed", "signal": ["v"], "aggregation": ["max", "avg"]}]}},
            {"clusters": ["two"], "details": {}},
        ],
    }


PERIOD = {"mode": "specific_period", "start_date": "2024-03-01", "end_date": "2024-03-02"}


@pytest.mark.parametrize(
    "date",
    [
        {},
        {"mode": "someday"},
        {"mode": "specific_period"},
        {"mode": "specific_period", "start_date": "2024-03-01"},
        {"mode": "specific_period", "start_date": "", "end_date": ""},
        {"mode": "specific_period", "start_date": "01.03.2024", "end_date": "2024-03-02"},
        {"mode": "specific_period", "start_date": "2024-03-02", "end_date": "2024-03-01"},
    ],
)
def test_bad_dates_are_refused(date):
    with pytest.raises(configs.ConfigError):
        configs.trip_config(aggregation_document(**date))


def test_trip_parameters_are_required():
    document = aggregation_document(**PERIOD)
    del document["config"]["trip"]["trip_gap_min"]
    with pytest.raises(configs.ConfigError):
        configs.trip_config(document)
    with pytest.raises(configs.ConfigError):
        configs.trip_config({"config": {}})


def test_date_modes_and_clusters(spark):
    config = configs.trip_config(aggregation_document(**PERIOD))
    assert (config.start, config.end) == (DAY, DAY + dt.timedelta(1))
    assert [c.name for c in config.clusters] == ["one", "two"]
    assert configs.date_range({"mode": "previous_day"}, today=DAY) == (dt.date(2024, 2, 29),) * 2
    plan = {tuple(r) for r in configs.cluster_plan(spark, config).select("cluster", "device", "signal", "aggregation").collect()}
    assert plan == {
        (c, d, "v", a)
        for c, d in (("one", "00000001"), ("one", "0000000E"), ("two", "0000000E"))
        for a in ("max", "avg")
    }


@pytest.mark.parametrize(
    "document",
    [None, [], ["x"], {"files": []}, {"config": {}, "files": []}, {"config": {"batch_size": {"min": 1}}, "files": []}, {"config": {"batch_size": {"max": 1}}, "files": []}, {"config": {"batch_size": {"min": 1, "max": 2}}}],
)
def test_incomplete_backlogs_are_refused(document):
    with pytest.raises(configs.ConfigError):
        configs.backlog_config(document)


def test_documents_on_disk(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"config": {"batch_size": {"min": 1, "max": 2}}, "files": ["a"]}, indent=1))
    (tmp_path / "bad.json").write_text("{oops")
    assert configs.backlog_config(configs.read_document(spark, str(tmp_path / "good.json"))) == (["a"], 1, 2)
    assert configs.read_document(spark, str(tmp_path / "bad.json")) is None
    assert configs.read_document(spark, str(tmp_path / "none.json")) is None
    assert configs.events_config(None)[1] == []


def test_first_catalog_group_wins(spark):
    document = {"dbc_groups": [{"devices": ["A", "B"], "dbc_files": ["1.dbc"]}, {"devices": ["B", "C"], "dbc_files": ["2.dbc", "3.dbc"]}]}
    got = configs.catalog_groups(spark.createDataFrame([(json.dumps(document),)], "document string"))
    assert {r.device: r.files for r in got.collect()} == {"A": ["1.dbc"], "B": ["1.dbc"], "C": ["2.dbc", "3.dbc"]}


def test_summary_of_a_stored_lake(spark):
    root = work_folder(spark, "lake")
    write_message(signals(spark, (DAY, DAY + dt.timedelta(5))), root)
    config = configs.trip_config(aggregation_document(**PERIOD))
    summary = trip_summary(spark, Lake.of_folder(spark, root), config)
    assert [f.name for f in TRIP_SUMMARY_SCHEMA] + ["date"] == summary.columns
    rows = summary.where("Aggregation = 'max'").collect()
    assert sorted((r.DeviceID, r.Cluster, r.SignalValue, r.SignalCount, r.Duration) for r in rows) == [
        ("00000001", "one", 6600.0, 12, 6600.0),
        ("0000000E", "one", 6600.0, 12, 6600.0),
        ("0000000E", "two", 6600.0, 12, 6600.0),
    ]
    assert rows[0].TripID.endswith("_20240301T000000.000000")
    assert days_processed(summary).first()[0] == 1


def test_summary_without_data_is_empty(spark):
    config = configs.trip_config(aggregation_document(**PERIOD))
    lake = Lake(lambda names, near: None, lambda: [])
    assert trip_summary(spark, lake, config).count() == 0


# --- events, triggers, paths --------------------------------------------------------------


def speed_event(**other):
    return {
        "event_name": "Fast",
        "messages_match_type": "equals",
        "messages_filtered_list": [["Speed"]],
        "trigger_signals": ["v"],
        "lower_threshold": 1000,
        "upper_threshold": 3000,
        "rising_as_start": True,
        "exact_match": False,
        "raster": "",
        **other,
    }


def test_event_rows_and_notice(spark):
    general, events = configs.events_config({"events": [speed_event(), speed_event(event_name="None", trigger_signals=["absent"])]})
    table = event_table(spark, Lake.of_frame(signals(spark)), general, events)
    assert table.columns[:11] == [f.name for f in EVENT_SCHEMA]
    rows = table.orderBy("DeviceID").collect()
    assert [(r.DeviceID, r.EventType, r.EventValue, r.SignalValue, r.EventId) for r in rows] == [
        (d, "Start", 1, 3000.0, f"Fast_{d}_20240301T005000") for d in ("00000001", "0000000E")
    ]
    (notice,) = first_notifications(table, "Look").collect()
    assert notice.subject == "- EVENT: Fast | 00000001 | 2024-03-01 00:50:00"
    assert notice.dedupe_id == "-_EVENT:_Fast__00000001__2024-03-01_00:50:00"
    assert notice.body == (
        "Fast was triggered. Look\n\nDetails:\n- device: 00000001\n- message(s): ['Speed']\n- file: f\n- time: 2024-03-01 00:50:00"
    )
    root = work_folder(spark, "events")
    write_events(table, root)
    assert spark.read.parquet(root).count() == 2


def test_event_on_the_position_message_itself(spark):
    rows = signals(spark).withColumnRenamed("v", "Latitude").withColumn("Longitude", F.lit(5.0))
    general, events = configs.events_config(
        {"general": {"messages_gps": ["Speed"]}, "events": [speed_event(trigger_signals=["Latitude"], raster="10min")]}
    )
    found = event_table(spark, Lake.of_frame(rows), general, events).collect()
    assert {(r.SignalValue, r.Latitude, r.Longitude) for r in found} == {(3000.0, 3000.0, 5.0)}


def test_lake_of_path_layout_feeds_the_jobs(spark, path_lake):
    lake = Lake.of_path_layout(spark, str(path_lake), devices=["0000000A"])
    assert lake.names() == ["Pos", "Speed"]
    assert lake.message("Absent") is None
    assert {r.device for r in lake.message("Speed").collect()} == {"0000000A"}
    root = work_folder(spark, "derived")
    config = {
        "custom_message_name": "Grid",
        "messages_match_type": "equals",
        "messages_filtered_list": [["Speed", "Pos"]],
        "raster": "1s",
        "prefix": True,
        "function": "resample",
    }
    assert write_custom_messages(lake, [config], root) == ["Grid"]
    (row,) = Lake.of_folder(spark, root).message("Grid").collect()
    assert (row.device, row.file_name, row.Speed_v, row.Pos_lat) == ("0000000A", "1.parquet", 1.0, 3.0)


def test_events_on_nothing(spark):
    lake = Lake(lambda names, near: None, lambda: [])
    assert event_table(spark, lake, configs.EVENT_DEFAULTS, [speed_event()]).count() == 0


def test_trigger_envelopes(spark):
    rows = [
        (1, "Amazon", json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "a+b/c%2Bd.MF4"}}}, {"s3": {}}]})),
        (2, "Azure", json.dumps({"url": "https://x.example/container/dev/ses/1.mfc?sig=1"})),
        (3, "Google", json.dumps({"data": {"name": "dev/ses/2.MFE"}})),
        (4, "Google", json.dumps(["p/q/3.MFM", "p/q/readme.txt", 7])),
        (5, "Amazon", json.dumps({"other": 1})),
        (6, "Nobody", json.dumps({"data": {"name": "x.MF4"}})),
        (7, "Google", "{broken"),
        (8, "Azure", json.dumps({"url": "https://x.example/container"})),
    ]
    got = trigger_paths(spark.createDataFrame(rows, "n int, provider string, envelope string"))
    assert sorted((r.n, r.path) for r in got.collect()) == [
        (1, "a b/c+d.MF4"),
        (2, "dev/ses/1.mfc"),
        (3, "dev/ses/2.MFE"),
        (4, "p/q/3.MFM"),
    ]


def test_path_expressions(spark):
    rows = spark.createDataFrame(
        [("0A0B0C0D/00000001/x.MF4",), ("0a0b0c0d/00000001/x.MF4",), ("0A0B0C0D/x.MF4",), ("0A0B0C0D",), ("a\\b",), ("a/b.c",), ("",), ("a/",)],
        "p string",
    )
    p = F.col("p")
    got = [tuple(r) for r in rows.select(device_of(p), as_prefix(p), forward_slashes(p)).collect()]
    assert [g[0] for g in got] == ["0A0B0C0D"] + [""] * 7
    assert [g[1] for g in got][2:] == ["0A0B0C0D/x.MF4", "0A0B0C0D/", "a\\b/", "a/b.c", "", "a/"]
    assert got[4][2] == "a/b"


def test_message_selection(spark):
    groups = spark.createDataFrame([(1, ["a", "ab", "c"]), (2, ["a"]), (3, ["c"])], "g int, messages array<string>")

    def chosen(*args, **kw):
        return {r.g: r.messages for r in select_messages(groups, *args, **kw).collect()}

    assert chosen("equals", ["a", "c"]) == {1: ["a", "c"], 2: ["a"], 3: ["c"]}
    assert chosen("equals", ["a", "c"], mode="all_present") == {1: ["a", "c"]}
    assert chosen("contains", "a") == {1: ["a", "ab"], 2: ["a"]}
    assert chosen("contains", "a", mode="all_present") == {1: ["a", "ab"]}
    assert chosen("contains", "zz", mode="all_present") == {}
    assert set(chosen("all_messages")) == {1, 2, 3}
    with pytest.raises(ValueError):
        chosen("starts")


@pytest.mark.parametrize("match", [("equals", [["Speed", "Load"]]), ("contains", "d"), ("all_messages", None)])
def test_derived_messages_of_one_day(spark, tmp_path, match):
    """Messages of other days, absent on the chosen one, change nothing; files may differ in columns."""

    def put(message, day, n, **signals):
        rows = [("A", dt.date(2024, 3, day), f"{n}.parquet", dt.datetime(2024, 3, day, h), *signals.values()) for h in (1, 2)]
        names = "".join(f", {s} double" for s in signals)
        write_path_layout(spark.createDataFrame(rows, f"device string, date date, file_name string, t timestamp{names}"), str(tmp_path), message)

    put("Speed", 1, 1, v=1.0)
    put("Speed", 1, 2, v=2.0, extra=3.0)
    put("Load", 1, 1, w=4.0)
    put("Load", 1, 2, w=5.0)
    put("Other", 2, 1, o=1.0)
    lake = Lake.of_path_layout(spark, str(tmp_path), dates=[dt.date(2024, 3, 1)])
    assert lake.names() == ["Load", "Speed"]
    assert Lake.of_path_layout(spark, str(tmp_path)).names() == ["Load", "Other", "Speed"]
    config = {
        "custom_message_name": "D", "messages_match_type": match[0], "messages_filtered_list": match[1],
        "raster": "", "prefix": False, "function": "resample",
    }
    rows = custom_message(lake, config).collect()
    assert sorted((r.file_name, r.t.hour, r.v, r.extra, r.w) for r in rows if r.v) == [
        ("1.parquet", 1, 1.0, None, None), ("1.parquet", 2, 1.0, None, None), ("2.parquet", 1, 2.0, 3.0, None), ("2.parquet", 2, 2.0, 3.0, None),
    ]
    assert sorted(r.w for r in rows if r.w) == [4.0, 4.0, 5.0, 5.0]


def test_events_see_every_signal_of_every_file(spark, tmp_path):
    """Messages with different signals, and a signal that only the second file has."""

    def put(message, n, **signals):
        rows = [("A", DAY, f"{n}.parquet", dt.datetime(2024, 3, 1, h), *(s[h] for s in signals.values())) for h in (0, 1)]
        names = "".join(f", {s} double" for s in signals)
        write_path_layout(spark.createDataFrame(rows, f"device string, date date, file_name string, t timestamp{names}"), str(tmp_path), message)

    put("One", 1, Speed=(0.0, 9.0))
    put("Two", 1, Other=(0.0, 9.0))
    put("Two", 2, Load=(0.0, 9.0), Other=(1.0, 1.0))
    event = {
        "event_name": "E", "messages_match_type": "all_messages", "trigger_signals": ["Speed", "Load"], "lower_threshold": 1,
        "upper_threshold": 5, "rising_as_start": True, "exact_match": False, "raster": "",
    }
    found = event_table(spark, Lake.of_path_layout(spark, str(tmp_path)), {}, [event]).collect()
    assert sorted((r.Message, r.Signal, r.file_name) for r in found) == [("One", "Speed", "1.parquet"), ("Two", "Load", "2.parquet")]


def test_path_layout_keeps_all_rows_under_a_bound_on_rows(spark, tmp_path):
    rows = [("A", DAY, f"{n}.parquet", dt.datetime(2024, 3, 1, h), float(h)) for n in (1, 2) for h in range(9)]
    df = spark.createDataFrame(rows, "device string, date date, file_name string, t timestamp, v double")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        assert write_path_layout(df, str(tmp_path), "M") == 2
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    found = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path)).collect()
    assert sorted(r.v for r in found) == sorted(r[4] for r in rows)


def test_fences_are_required_and_ids_may_be_text(spark):
    from fleetlake.functions.geo import with_fence
    from fleetlake.operators.custom import apply_custom

    df = spark.createDataFrame([("A", DAY, "f", dt.datetime(2024, 3, 1), 56.0, 10.0)], "device string, date date, file_name string, t timestamp, Latitude double, Longitude double")
    with pytest.raises(ValueError):
        apply_custom(df, "custom_geofences")
    fence = {"id": "north", "name": "", "latitude": 56.0, "longitude": 10.0, "radius": 1.0}
    far = [{**fence, "id": f"far{i}", "latitude": -50.0 + i / 10} for i in range(100)]
    for fences in ([fence], [*far, fence], [*far, {**fence, "radius": 3000.0}]):
        assert with_fence(df, fences).first().GeofenceId == "north"
    assert with_fence(df, far).first().GeofenceId == "0"
    with pytest.raises(ValueError):
        with_fence(df, [{**fence, "latitude": 91.0}])


# --- names as they are ----------------------------------------------------------------------

NAMES = ["b 1#x.parquet", "k=v.parquet", "a+b.parquet", "100%.parquet", "%20.parquet", "ü é.parquet", "q?.parquet", "2024-01-01T10:00.parquet", "a%3Ab:c%25.parquet"]


def named_rows(spark):
    rows = [("0000 A", "my Speed", DAY, name, at(60, DAY), float(i)) for i, name in enumerate(NAMES)]
    return spark.createDataFrame(rows, "device string, message string, date date, file_name string, t timestamp, v double")


def test_awkward_file_names_come_back(spark):
    root = work_folder(spark, "names")
    assert write_path_layout(named_rows(spark), root) == len(NAMES)
    found = read_path_layout(spark, root).collect()
    assert sorted((r.device, r.message, r.file_name, r.v) for r in found) == sorted(("0000 A", "my Speed", n, float(i)) for i, n in enumerate(NAMES))
    assert sorted(f for _, _, files in os.walk(root) for f in files if not f.startswith((".", "_"))) == sorted(stored_name(n) for n in NAMES)


def test_awkward_names_through_streams(spark):
    root, out = work_folder(spark, "names"), work_folder(spark, "names-out")
    rows = named_rows(spark).withColumn("Speed", F.col("v") + 50)
    low = rows.withColumn("t", F.col("t") - F.expr("interval 1 minute")).withColumn("Speed", F.lit(0.0))
    write_path_layout(rows.unionByName(low).withColumn("message", F.lit("click")), root)
    rule = {"event_name": "Up", "messages_match_type": "equals", "messages_filtered_list": [["click"]], "trigger_signals": ["Speed"]}
    rule |= {"lower_threshold": 1, "upper_threshold": 40, "rising_as_start": True, "exact_match": False, "raster": ""}
    general, events = configs.events_config({"general": {"include_gps_data": False}, "events": [rule]})
    run_whole_files(spark, root, Incremental((), general, events, None, f"{out}/events"), f"{out}/checkpoint")
    assert sorted(r.file_name for r in latest(spark, f"{out}/events").collect()) == sorted(NAMES)


def test_a_failed_move_keeps_the_file(spark, monkeypatch):
    """A rename that says no is an error, and the finished file is still there."""
    root = work_folder(spark, "blocked")
    write_path_layout(named_rows(spark).where("v = 0"), root)
    real = lake_module._move_all

    def refuse(spark, fs, moves):
        class Refusing:
            def __getattr__(self, name):
                return (lambda *_: False) if name == "rename" else getattr(fs, name)

        return real(spark, Refusing(), moves)

    monkeypatch.setattr(lake_module, "_move_all", refuse)
    with pytest.raises(lake_module.MoveFailed) as error:
        write_path_layout(named_rows(spark).where("v = 1"), root)
    staging = re.search(r"still in (\S+),", str(error.value))[1]
    assert spark.read.parquet(staging).count() == 1


def test_rules_of_many_documents_are_those_of_each(spark):
    """Rules read as a table equal the settings that the checked readers give for each document."""
    block = {"clusters": ["a", "b"], "details": {"trip_identifier": {"message": "T"}, "aggregations": [
        {"message": "M", "signal": ["x", "y"], "aggregation": ["avg", "sum"]}, {"message": "", "signal": ["z"], "aggregation": ["max"]}]}}
    mute = {"clusters": ["c", "a"], "details": {"trip_identifier": {"message": ""}, "aggregations": []}}
    period = {"mode": "specific_period", "start_date": "2024-01-01", "end_date": "2024-01-02"}
    trips = {
        "config": {"date": period, "trip": {"trip_gap_min": 1.5, "trip_min_length_min": 0}},
        "device_clusters": [{"devices": ["D1", "D2"], "cluster": "a"}, {"devices": ["D3"], "cluster": "c"}, {"devices": ["D4"], "cluster": "d"}],
        "cluster_details": [block, mute],
    }
    other = {**trips, "cluster_details": [mute, block]}
    texts = [("one", json.dumps(trips)), ("two", json.dumps(other)), ("broken", "{"), ("none", None), ("empty", "{}")]
    docs = spark.createDataFrame(texts, "name string, document string")
    rules = configs.aggregation_rules(docs)
    for name, document in (("one", trips), ("two", other)):
        config = configs.trip_config(document)
        plan = configs.cluster_plan(spark, config)
        mine = rules.where(F.col("name") == name)
        assert sorted(mine.select(plan.columns).collect()) == sorted(plan.collect())
        assert {(r.gap_us, r.min_length_us) for r in mine.collect()} <= {(config.gap_us, config.min_length_us)}
    assert {r.name for r in rules.collect()} == {"one"}

    events = {"general": {"include_gps_data": False}, "events": [{"event_name": "e", "lower_threshold": 1, "messages_filtered_list": [["A"]]}]}
    got = configs.event_rules(spark.createDataFrame([("one", json.dumps(events)), ("broken", "[")], "name string, document string")).collect()
    general, (event,) = configs.events_config(events)
    assert [(r.name, r.pos, r.event_name, r.lower_threshold, json.loads(r.messages_filtered_list)) for r in got] == [
        ("one", 0, event["event_name"], event["lower_threshold"], event["messages_filtered_list"])
    ]
    assert {k: got[0][k] for k in general} == general
    custom = [{"custom_message_name": "m", "prefix": True}, {"function": "f"}]
    got = configs.custom_rules(spark.createDataFrame([(json.dumps(custom),), ("",)], "document string")).collect()
    assert [(r.pos, r.custom_message_name, r.prefix, r.function) for r in got] == [(0, "m", True, None), (1, None, None, "f")]
