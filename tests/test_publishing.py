"""A batch is published in one step, or not at all."""

import logging

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.custom import CustomContext
from fleetlake.plans.event_table import detect_event
from fleetlake.session import work_folder
from fleetlake.sources.configs import events_config
from fleetlake.sources.lake import Lake, PublishedNothing, _folders
from fleetlake.streaming.incremental import Incremental, run_whole_files
from fleetlake.streaming.publishing import DECODED, DERIVED, EVENTS, Publication
from fleetlake.suite.base import signals
from fleetlake.suite.grid import FENCES
from fleetlake.suite.streams import CUSTOM
from fleetlake.suite.streams import EVENTS as CONFIG

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    """Six days of two devices."""
    return signals(spark, SF, 2).where(F.dayofmonth("date") <= 6)


def job(publication, **more):
    general, events = events_config(CONFIG)
    return Incremental(CUSTOM, general, events, context=CustomContext(fences=FENCES), width="6 hours", publication=publication, **more)


def part(df, n):
    return df.where(F.pmod(F.dayofmonth("date"), F.lit(3)) == n)


def test_all_kinds_with_counts(spark, rows):
    seen, told = [], []
    publication = Publication(work_folder(spark, "out"), lambda kind, df: seen.append(kind) or df.withColumn("Checked", F.lit(True)))
    for n in range(2):
        job(publication, deliver=told.extend)(part(rows, n), n)
    assert seen == [DECODED, DERIVED, EVENTS] * 2
    counts = {(r.batch_id, r.kind): r.rows for r in publication.counts(spark).collect()}
    for kind in (DECODED, DERIVED, EVENTS):
        found = publication.rows(spark, kind)
        assert found.where("Checked").count() == counts[0, kind] + counts[1, kind] > 0
        assert publication.rows(spark, kind, 1).count() == counts[1, kind]
    assert counts[0, DECODED] == part(rows, 0).count()
    # The one event name is told once, after it was published.
    assert [n.EventName for n in told] == ["AtDepot"]


def test_a_failed_batch_shows_nothing_and_is_replaced(spark, rows):
    root = work_folder(spark, "out")

    def fails(kind, df):
        if kind == EVENTS:
            raise OSError("store is away")
        return df

    job(Publication(root))(part(rows, 0), 0)
    with pytest.raises(OSError):
        job(Publication(root, fails))(part(rows, 1), 1)
    # Its rows are there, but don't count.
    assert _folders(spark, f"{root}/decoded/batch_id=1")
    publication = Publication(root)
    assert publication.rows(spark, DECODED).count() == part(rows, 0).count()
    assert publication.rows(spark, DECODED, 1) is None
    # The next attempt has other rows, and nothing of the first one is left.
    job(publication)(part(rows, 2), 1)
    assert publication.rows(spark, DECODED).count() == part(rows, 0).count() + part(rows, 2).count()
    # Columns that come later are null before.
    job(Publication(root, lambda kind, df: df.withColumn("Late", F.lit(1))))(part(rows, 1), 2)
    late = publication.rows(spark, DECODED)
    assert late.where("Late IS NULL").count() == part(rows, 0).count() + part(rows, 2).count()
    assert late.where("Late = 1 AND batch_id = 2").count() == part(rows, 1).count()
    assert dict(late.dtypes)["device"] == "string"
    # A batch that was published is not written again.
    before = sorted(map(str, publication.rows(spark, DECODED).collect()))
    job(publication)(part(rows, 1), 1)
    assert sorted(map(str, publication.rows(spark, DECODED).collect())) == before


def test_nothing_to_publish_is_an_error(spark, rows):
    publication = Publication(work_folder(spark, "out"), lambda kind, df: df.where("1 = 0"))
    with pytest.raises(PublishedNothing):
        job(publication)(rows, 0)
    assert publication.counts(spark).collect() == []
    assert publication.rows(spark, DECODED) is None
    # One kind without rows is none.
    some = Publication(work_folder(spark, "out"), lambda kind, df: df.where(F.lit(kind == DECODED)))
    job(some)(rows, 0)
    assert some.rows(spark, DECODED).count() == rows.count()
    assert {r.kind: r.rows > 0 for r in some.counts(spark).collect()} == {DECODED: True, DERIVED: False, EVENTS: False}
    with pytest.raises(PublishedNothing):
        some.publish({}, 1)
    with pytest.raises(ValueError, match="unknown"):
        some.publish({"other": rows}, 1)
    with pytest.raises(ValueError):
        run_whole_files(spark, "/nowhere", job(some), "/nowhere")


def test_events_without_their_signals_are_told(rows, caplog):
    frames = {"view": rows.drop("Load")}
    lake = Lake(lambda names, near: frames.get(names[0]), lambda: list(frames))
    _, (event,) = events_config(CONFIG)
    with caplog.at_level(logging.WARNING):
        for message, triggers in (("nowhere", ["Speed"]), ("view", ["Load"]), ("view", ["Load", "Speed"]), ("view", ["Speed"])):
            wanted = event | {"messages_filtered_list": [[message]], "trigger_signals": triggers}
            assert (detect_event(lake, wanted, width="6 hours") is None) == ("Speed" not in triggers or message == "nowhere")
    assert [r.getMessage() for r in caplog.records if r.name.startswith("fleetlake")] == [
        "event AtDepot is skipped: none of its messages is in the lake",
        "event AtDepot: no file has its trigger signals Load",
        "event AtDepot: no file has its trigger signals Load",
    ]
