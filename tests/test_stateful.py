"""Keyed state, notices once, merged results and summaries of touched days."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.custom import CustomContext
from fleetlake.operators.edges import detect_edges
from fleetlake.plans.custom_messages import custom_messages
from fleetlake.plans.event_table import event_table
from fleetlake.plans.trip_summary import trip_summary
from fleetlake.session import work_folder
from fleetlake.sources.configs import events_config, trip_config
from fleetlake.sources.lake import Lake, write_path_layout
from fleetlake.streaming.incremental import Incremental, latest, run_incremental, run_whole_files, stream_files
from fleetlake.streaming.keyed import Flags, stream_edges, use_rocksdb
from fleetlake.streaming.notices import NoticeLedger
from fleetlake.streaming.results import compact
from fleetlake.streaming.summaries import read_ledger, read_summary, run_trip_summary
from fleetlake.suite.base import as_signals
from fleetlake.suite.grid import FENCES
from fleetlake.suite.streams import CUSTOM, EVENTS

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def rocksdb(spark):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    yield use_rocksdb(spark)
    spark.conf.set(setting, before)


def literal_edges(values, lower, upper):
    """The run definition word by word: first candidate row of each run."""
    below, above = ([v is not None and p(v) for v in values] for p in (lambda v: v <= lower, lambda v: v >= upper))
    out = []
    for flag, other, kind in ((above, below, "rise"), (below, above, "fall")):
        run, hit = 0, set()
        for i in range(len(values)):
            run += i > 0 and other[i] != other[i - 1]
            if flag[i] and any(other[:i]) and run not in hit:
                hit.add(run)
                out.append((i, kind))
    return sorted(out)


@pytest.mark.parametrize("lower,upper", [(3, 6), (5, 5), (6, 3)])
def test_flags_follow_the_run_definition(lower, upper):
    rnd = random.Random(lower * 10 + upper)
    for _ in range(200):
        values = [rnd.choice([None, *range(10)]) for _ in range(rnd.randint(0, 30))]
        flags, found = Flags(), []
        for i, v in enumerate(values):
            rising, falling = flags.step(v is not None and v <= lower, v is not None and v >= upper)
            found += [(i, "rise")] * rising + [(i, "fall")] * falling
        assert sorted(found) == literal_edges(values, lower, upper)


@pytest.mark.parametrize("lower,upper,exact", [(30, 60, False), (50, 40, False)])
def test_edges_of_shuffled_files(spark, rocksdb, lower, upper, exact):
    """Rows in any order within the delay, a stream that is started anew for each file, a bounded state."""
    rnd = random.Random(1)
    rows = [(f"D{i % 3}", START + dt.timedelta(seconds=7 * i), rnd.choice([None, float(rnd.randint(0, 99))])) for i in range(900)]
    folder, out = work_folder(spark, "shuffled"), work_folder(spark, "edges")
    kept = []
    for part in (1, 0, 2):
        # Each file spans half an hour; the first two come the wrong way round.
        own = [r for r in rows if (r[1] - START) // dt.timedelta(minutes=35) == part]
        rnd.shuffle(own)
        spark.createDataFrame(own, "device string, t timestamp, v double").coalesce(1).write.mode("append").parquet(folder)
        stream = stream_files(spark, folder, spark.read.parquet(folder).schema)
        edges = stream_edges(stream, "v", lower, upper, exact, keys=["device"], late="70 minutes")
        writer = edges.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        query = writer.option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").start()
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    df = spark.createDataFrame(rows, "device string, t timestamp, v double")
    counted = df.where((F.col("v") <= lower) | (F.col("v") >= upper)) if lower < upper else df
    upto = counted.agg(F.date_trunc("millisecond", F.max("t")).alias("m")).first().m - dt.timedelta(minutes=70)
    expected = detect_edges(df, "v", lower, upper, exact, keys=["device"]).where(F.col("t") <= F.lit(upto))
    found = spark.read.parquet(f"{out}/rows").select(*expected.columns)
    assert expected.count() > 20
    assert sorted(found.collect()) == sorted(expected.collect())
    # Flags, held rows and timers of three series: no more for the last file than for the first.
    assert max(kept) <= 3 * 300 + 3 * 4


NOTICES = "EventName string, DeviceID string, t timestamp, subject string, body string, dedupe_id string"


def notice(n, name="A"):
    return (name, "D", START + dt.timedelta(hours=n), f"s{n}", "b", f"id-{name}-{n}")


def test_a_notice_is_sent_once(spark):
    ledger, sent = NoticeLedger(work_folder(spark, "ledger")), []

    def batch(number, *notices, fail=False):
        def deliver(rows):
            if fail:
                raise OSError("no line")
            sent.extend(r.dedupe_id for r in rows)

        return ledger.deliver_new(spark.createDataFrame(list(notices), NOTICES), number, deliver)

    assert batch(0) == 0
    assert batch(1, notice(1)) == 1
    assert batch(2, notice(2), notice(3, "B")) == 1
    # A batch that fails while sending is repeated with the same notices; one that was sent is not.
    with pytest.raises(OSError):
        batch(3, notice(4, "C"), fail=True)
    assert batch(3, notice(4, "C")) == 1
    assert batch(3, notice(4, "C")) == 0
    again = NoticeLedger(ledger.folder)
    assert again.deliver_new(spark.createDataFrame([notice(9)], NOTICES), 4, sent.extend) == 0
    assert sent == ["id-A-1", "id-B-3", "id-C-4"]
    by_id = NoticeLedger(work_folder(spark, "ledger"), once="dedupe_id")
    assert [by_id.deliver_new(spark.createDataFrame([notice(n)], NOTICES), n, lambda rows: None) for n in (1, 2)] == [1, 1]


def test_notices_over_batches_and_restarts(spark):
    folder, out = work_folder(spark, "in"), work_folder(spark, "notices")
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    general, configured = events_config(EVENTS)
    delivered = []
    for first in (1, 4, 7):
        days = events.where(F.dayofmonth("ts").between(first, first + 2))
        days.coalesce(1).write.mode("append").parquet(folder)
        job = Incremental(CUSTOM, general, configured, None, f"{out}/events", CustomContext(fences=FENCES), deliver=delivered.extend)
        run_incremental(as_signals(stream_files(spark, folder, events.schema, files_per_batch=1)), job, f"{out}/checkpoint")
    assert spark.read.parquet(f"{out}/events").where("EventValue = 1").select("date").distinct().count() > 1
    assert [r.EventName for r in delivered] == ["AtDepot"]


# --- Merged results ---------------------------------------------------------------------------

RULES = {
    "general": {"include_gps_data": False},
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
            "raster": "",
        }
    ],
}
DERIVED = [
    {
        "custom_message_name": "Kept",
        "messages_match_type": "equals",
        "messages_filtered_list": [["click"]],
        "raster": "1h",
        "prefix": False,
        "function": "resample",
    }
]


def put(spark, root, day, values, name="1.parquet", device="A", message="click"):
    rows = [(device, day, name, dt.datetime.combine(day, dt.time(h)), v) for h, v in values]
    df = spark.createDataFrame(rows, "device string, date date, file_name string, t timestamp, Speed double")
    write_path_layout(df, root, message)


def folders(root, depth):
    return sorted(os.path.relpath(os.path.join(a, d), root) for a, dirs, _ in os.walk(root) for d in dirs if os.path.relpath(os.path.join(a, d), root).count("/") == depth)


def test_many_batches_are_folded(spark):
    root, out = work_folder(spark, "lake"), work_folder(spark, "out")
    general, events = events_config(RULES)
    job = Incremental(DERIVED, general, events, f"{out}/lake", f"{out}/events", compact_every=2)
    columns = ["t", "EventName", "DeviceID", "EventType", "file_name"]

    def check():
        lake = Lake.of_path_layout(spark, root)
        expected = event_table(spark, lake, general, events).select(*columns).collect()
        assert sorted(map(repr, latest(spark, f"{out}/events").select(*columns).collect())) == sorted(map(repr, expected))

    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    for n in range(7):
        day = days[n % 4]
        put(spark, root, day, [(1, 10.0), (2, 90.0), *([(3, 10.0), (4, 99.0)] if n >= 4 else [])])
        if n >= 4:
            # Another message of a log file makes it be read again, so that base rows are superseded.
            put(spark, root, day, [(1, 0.0)], message="view")
        if n == 5:
            put(spark, root, day, [(1, 10.0), (2, 60.0)], "2.parquet", "B")
        run_whole_files(spark, root, job, f"{out}/checkpoint")
        if n in (2, 5):
            check()
    check()
    # Two snapshots stay, and what they need; older batches, notes and versions are gone.
    assert len(folders(f"{out}/events/_snapshots", 0)) == 2
    batches = {int(f.rsplit("=", 1)[1]) for f in folders(f"{out}/events", 1) if "batch_id=" in f and not f.startswith("_")}
    assert min(batches) > 2
    assert len(folders(f"{out}/events/_touched", 0)) <= 4
    assert {f.split("/")[0] for f in folders(f"{out}/events/_base", 1)} <= {f"version={v}" for v in range(8)}
    kept = latest(spark, f"{out}/lake", "Kept").select("device", "date", "file_name", "t", "Speed")
    whole = custom_messages(Lake.of_path_layout(spark, root), DERIVED)["Kept"].select(*kept.columns)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, whole.collect()))
    # Folding all the rest changes nothing, and a second time there is nothing to do.
    assert compact(spark, f"{out}/events", ["date"]) is not None
    assert compact(spark, f"{out}/events", ["date"]) is None
    check()


def test_an_unfinished_snapshot_does_not_count(spark):
    root, out = work_folder(spark, "lake"), work_folder(spark, "out")
    general, events = events_config(RULES)
    job = Incremental((), general, events, None, f"{out}/events")
    put(spark, root, dt.date(2024, 1, 1), [(1, 10.0), (2, 90.0)])
    run_whole_files(spark, root, job, f"{out}/checkpoint")
    assert compact(spark, f"{out}/events", ["date"]) == 0
    os.remove(f"{out}/events/_snapshots/0/_SUCCESS")
    assert latest(spark, f"{out}/events").count() == 1
    assert compact(spark, f"{out}/events", ["date"]) == 0
    assert latest(spark, f"{out}/events").count() == 1


# --- Trip summary of touched days ---------------------------------------------------------------

TRIPS = {
    "config": {
        "date": {"mode": "specific_period", "start_date": "2024-01-01", "end_date": "2024-01-05"},
        "trip": {"trip_gap_min": 90, "trip_min_length_min": 1},
    },
    "device_clusters": [{"devices": ["A", "B"], "cluster": "all"}],
    "cluster_details": [
        {
            "clusters": ["all"],
            "details": {"trip_identifier": {"message": "click"}, "aggregations": [{"message": "click", "signal": ["Speed"], "aggregation": ["max", "sum"]}]},
        }
    ],
}


def test_late_files_rewrite_only_their_device_days(spark):
    root, out = work_folder(spark, "lake"), work_folder(spark, "summary")
    config = trip_config(TRIPS)
    for device in "AB":
        for day in range(1, 6):
            put(spark, root, dt.date(2024, 1, day), [(1, 1.0), (2, 2.0)], device=device)

    def run():
        run_trip_summary(spark, root, f"{out}/rows", config, f"{out}/checkpoint")
        expected = trip_summary(spark, Lake.of_path_layout(spark, root), config)
        found = read_summary(spark, f"{out}/rows").select(*expected.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
        return {f: os.stat(f"{out}/rows/{f}").st_mtime_ns for f in folders(f"{out}/rows", 1) if f.startswith("date=")}

    before = run()
    assert len(before) == 10
    late = [("A", 2), ("B", 2), ("B", 4)]
    for device, day in late:
        put(spark, root, dt.date(2024, 1, day), [(3, 5.0), (9, 1.0), (10, 2.0)], "2.parquet", device)
    put(spark, root, dt.date(2024, 2, 1), [(1, 1.0)], device="A")  # outside the period
    after = run()
    assert {f for f in after if after[f] != before[f]} == {f"date=2024-01-{day:02d}/device={device}" for device, day in late}
    ledger = read_ledger(spark, f"{out}/rows").where("batch_id > 0").collect()
    assert {(r.device, r.date.day) for r in ledger} == set(late)
    # A log file that was cut short so that it has no trip: its day has no folder any more.
    put(spark, root, dt.date(2024, 1, 5), [(1, 1.0)], device="A")
    put(spark, root, dt.date(2024, 1, 5), [(1, 1.0)], device="A", message="view")
    assert "date=2024-01-05/device=A" not in run()
