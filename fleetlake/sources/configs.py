"""The JSON documents that steer the jobs, as tables and as checked settings.

Documents are a few kilobytes; ``read_document`` brings one to the driver. ``parse_documents``
with a schema of ``DOCUMENTS`` keeps many of them in DataFrames, and ``aggregation_rules``, ``event_rules`` and
``custom_rules`` turn the documents of a whole fleet of configurations into tables of rules.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Document schemas (fixed formats).
AGGREGATIONS_DOC = """
config struct<
  date: struct<mode: string, start_date: string, end_date: string>,
  trip: struct<trip_gap_min: double, trip_min_length_min: double>>,
device_clusters array<struct<devices: array<string>, cluster: string>>,
cluster_details array<struct<
  clusters: array<string>,
  details: struct<
    trip_identifier: struct<message: string>,
    aggregations: array<struct<message: string, signal: array<string>, aggregation: array<string>>>>>>
"""
EVENTS_DOC = """
general struct<include_gps_data: boolean, signal_latitude: string, signal_longitude: string,
  messages_gps: array<string>, static_body_content: string>,
events array<struct<event_name: string, messages_match_type: string, messages_filtered_list: string,
  trigger_signals: array<string>, lower_threshold: double, upper_threshold: double,
  rising_as_start: boolean, exact_match: boolean, raster: string>>
"""
CUSTOM_DOC = """
array<struct<messages_filtered_list: string, messages_match_type: string, raster: string,
  custom_message_name: string, prefix: boolean, function: string>>
"""
GEOFENCES_DOC = "array<struct<id: bigint, name: string, latitude: double, longitude: double, radius: double>>"
BACKLOG_DOC = "config struct<batch_size: struct<min: int, max: int>>, files array<string>"
GROUPS_DOC = "dbc_groups array<struct<devices: array<string>, dbc_files: array<string>>>"


#: The schema of each kind of document, by name.
DOCUMENTS = {
    "aggregations": AGGREGATIONS_DOC,
    "events": EVENTS_DOC,
    "custom-messages": CUSTOM_DOC,
    "geofences": GEOFENCES_DOC,
    "backlog": BACKLOG_DOC,
    "dbc-groups": GROUPS_DOC,
}


class ConfigError(ValueError):
    """A document that is present but cannot be used."""


def read_document(spark: SparkSession, path: str):
    """The parsed document, or None if it is missing or not valid JSON."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except Exception as error:  # the reader reports a missing path in several ways
        if "PATH_NOT_FOUND" not in str(error):
            raise
        log.info("no %s - step is skipped", path)
        return None
    try:
        return json.loads(row[0]) if row else None
    except json.JSONDecodeError as error:
        log.warning("%s is not valid JSON: %s", path, error)
        return None


def _field(document: Mapping, *names: str):
    value = document
    for name in names:
        if not isinstance(value, Mapping) or name not in value:
            raise ConfigError(f"missing '{'.'.join(names)}'")
        value = value[name]
    return value


# --- aggregations -----------------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    message: str
    signals: tuple[str, ...]
    aggregations: tuple[str, ...]


@dataclass(frozen=True)
class Cluster:
    name: str
    devices: tuple[str, ...]
    trip_message: str
    specs: tuple[Spec, ...]


@dataclass(frozen=True)
class TripConfig:
    start: date
    end: date
    gap_us: int
    min_length_us: int
    clusters: tuple[Cluster, ...]


def _day(text: str, name: str) -> date:
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError) as error:
        raise ConfigError(f"{name} must be a YYYY-MM-DD date, not {text!r}") from error


def date_range(settings: Mapping, today: date | None = None) -> tuple[date, date]:
    """First and last day (both included) of a date setting."""
    mode = settings.get("mode")
    if mode == "previous_day":
        yesterday = (today or date.today()) - timedelta(days=1)
        return yesterday, yesterday
    if mode == "specific_period":
        start = _day(_field(settings, "start_date"), "start_date")
        end = _day(_field(settings, "end_date"), "end_date")
        if end < start:
            raise ConfigError(f"end_date {end} is before start_date {start}")
        return start, end
    raise ConfigError(f"unknown date mode: {mode!r}")


def trip_config(document: Mapping, today: date | None = None) -> TripConfig:
    """Checked trip-summary settings.

    A cluster takes the first detail block that lists it; clusters without one, or without a
    trip message, are reported and skipped.
    """
    start, end = date_range(_field(document, "config", "date"), today)
    minute = 60_000_000
    gap = round(float(_field(document, "config", "trip", "trip_gap_min")) * minute)
    shortest = round(float(_field(document, "config", "trip", "trip_min_length_min")) * minute)
    clusters = []
    for entry in document.get("device_clusters", []):
        name = entry.get("cluster")
        detail = next(
            (d for d in document.get("cluster_details", []) if name in d.get("clusters", [])), None
        )
        if detail is None:
            log.warning("cluster %s has no details - skipped", name)
            continue
        details = detail.get("details", {})
        trip_message = details.get("trip_identifier", {}).get("message", "")
        if not trip_message:
            log.warning("cluster %s names no trip message - skipped", name)
            continue
        specs = tuple(
            Spec(a["message"], tuple(a.get("signal", [])), tuple(a.get("aggregation", [])))
            for a in details.get("aggregations", [])
            if a.get("message")
        )
        clusters.append(Cluster(name, tuple(entry.get("devices", [])), trip_message, specs))
    return TripConfig(start, end, gap, shortest, tuple(clusters))


def cluster_plan(spark: SparkSession, config: TripConfig) -> DataFrame:
    """One row per cluster, device, message, signal and aggregation, as configured."""
    rows = [
        (c.name, list(c.devices), c.trip_message, [(s.message, list(s.signals), list(s.aggregations)) for s in c.specs])
        for c in config.clusters
    ]
    nested = spark.createDataFrame(
        rows,
        "cluster string, devices array<string>, trip_message string, "
        "specs array<struct<message: string, signals: array<string>, aggregations: array<string>>>",
    )
    return (
        nested.select("cluster", "trip_message", F.explode("devices").alias("device"), "specs")
        .select("cluster", "trip_message", "device", F.explode("specs").alias("s"))
        .select("cluster", "trip_message", "device", "s.message", F.explode("s.signals").alias("signal"), "s.aggregations")
        .withColumn("aggregation", F.explode("aggregations"))
        .drop("aggregations")
    )


# --- other documents --------------------------------------------------------------------


def backlog_config(document) -> tuple[list[str], int, int]:
    """``(entries, min, max)`` of a backlog manifest; every field is required."""
    if not isinstance(document, Mapping):
        raise ConfigError("a backlog manifest is an object with 'config' and 'files'")
    files = _field(document, "files")
    return (
        list(files),
        int(_field(document, "config", "batch_size", "min")),
        int(_field(document, "config", "batch_size", "max")),
    )


# Defaults of the general section of an events document (fixed values).
EVENT_DEFAULTS = {
    "messages_gps": ["CAN9_GnssPos"],
    "include_gps_data": True,
    "signal_latitude": "Latitude",
    "signal_longitude": "Longitude",
    "static_body_content": "Review details via e.g. your event dashboard",
}


def events_config(document) -> tuple[dict, list[dict]]:
    """``(general, events)``; a missing document means no events."""
    if not document:
        return dict(EVENT_DEFAULTS), []
    return {**EVENT_DEFAULTS, **document.get("general", {})}, list(document.get("events", []))


def catalog_groups(documents: DataFrame, column: str = "document") -> DataFrame:
    """``device, files`` - the catalog files of the first group that lists the device.

    ``documents`` holds dbc-group documents as JSON text; groups keep their order in it.
    """
    groups = documents.select(
        F.posexplode(F.from_json(column, GROUPS_DOC)["dbc_groups"]).alias("pos", "g")
    )
    return (
        groups.select("pos", F.explode("g.devices").alias("device"), "g.dbc_files")
        .groupBy("device")
        .agg(F.min_by("dbc_files", "pos").alias("files"))
    )


def aggregation_rules(documents: DataFrame, column: str = "document") -> DataFrame:
    """The trip-summary rules of many aggregation documents, one row per device, signal and aggregation.

    The other columns of ``documents``, then ``gap_us, min_length_us, cluster, trip_message, device, message, signal,
    aggregation``. As in ``trip_config``, a cluster takes the first detail block that lists it, and one without a block
    or a trip message has no rules. Unreadable documents have none either.
    """
    others = [c for c in documents.columns if c != column]
    doc = F.from_json(column, AGGREGATIONS_DOC)
    minute = 60_000_000
    trip = F.col("d.config.trip")
    clusters = documents.select(*others, doc.alias("d")).select(
        *others,
        F.round(trip["trip_gap_min"] * minute).cast("long").alias("gap_us"),
        F.round(trip["trip_min_length_min"] * minute).cast("long").alias("min_length_us"),
        F.col("d.cluster_details").alias("_all"),
        F.explode("d.device_clusters").alias("c"),
    )
    first = F.get(F.filter("_all", lambda detail: F.array_contains(detail["clusters"], F.col("c.cluster"))), F.lit(0))
    head = [*others, "gap_us", "min_length_us", "cluster", "trip_message"]
    return (
        clusters.withColumn("cluster", F.col("c.cluster"))
        .withColumn("_details", first["details"])
        .withColumn("trip_message", F.col("_details.trip_identifier.message"))
        .where(F.col("trip_message") != "")
        .select(*head, F.explode("c.devices").alias("device"), F.col("_details.aggregations").alias("_specs"))
        .select(*head, "device", F.explode("_specs").alias("s"))
        .where(F.col("s.message") != "")
        .select(*head, "device", "s.message", F.explode("s.signal").alias("signal"), "s.aggregation")
        .withColumn("aggregation", F.explode("aggregation"))
    )


def event_rules(documents: DataFrame, column: str = "document") -> DataFrame:
    """The events of many event documents: their other columns, ``pos``, the general settings, the event's fields.

    Settings that a document leaves out have their defaults. Message lists stay JSON text, for they nest as they like.
    """
    others = [c for c in documents.columns if c != column]
    parsed = documents.select(*others, F.from_json(column, EVENTS_DOC).alias("d"))
    general = [F.coalesce(F.col(f"d.general.{name}"), F.lit(value)).alias(name) for name, value in EVENT_DEFAULTS.items()]
    return parsed.select(*others, *general, F.posexplode("d.events").alias("pos", "e")).select(
        *others, "pos", *EVENT_DEFAULTS, "e.*"
    )


def custom_rules(documents: DataFrame, column: str = "document") -> DataFrame:
    """The derived messages of many custom-message documents: their other columns, ``pos`` and the message's fields."""
    others = [c for c in documents.columns if c != column]
    return documents.select(*others, F.posexplode(F.from_json(column, CUSTOM_DOC)).alias("pos", "m")).select(*others, "pos", "m.*")


def parse_documents(documents: DataFrame, schema: str, column: str = "document") -> DataFrame:
    """JSON texts parsed by one of the document schemas; unreadable ones are left out."""
    parsed: Column = F.from_json(column, schema)
    return documents.withColumn("parsed", parsed).where(F.col("parsed").isNotNull())


def message_lists(match_type: str, filtered) -> Sequence:
    """The configured list of message lists; a bare text stands for itself."""
    if match_type == "equals":
        return [list(m) for m in filtered]
    return [filtered]
