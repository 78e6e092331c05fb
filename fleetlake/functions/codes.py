"""Expressions for fault-code messages and display ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_address(message: Column) -> Column:
    """The last two hex digits of a message name as a number."""
    return F.conv(F.right(message, F.lit(2)), 16, 10).cast("int")


def trip_id(device: Column, start: Column) -> Column:
    return F.concat(device, F.lit("_"), F.date_format(start, "yyyyMMdd'T'HHmmss.SSSSSS"))


def event_id(event_name: Column, device: Column, t: Column) -> Column:
    return F.concat_ws("_", event_name, device, F.date_format(t, "yyyyMMdd'T'HHmmss"))
