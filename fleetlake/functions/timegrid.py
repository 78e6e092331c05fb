"""Microsecond arithmetic for rasters, gaps and time chunks."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

# Raster units accepted in configs, in microseconds (fixed values).
_UNIT_US = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "sec": 1_000_000,
    "second": 1_000_000,
    "min": 60_000_000,
    "minute": 60_000_000,
    "h": 3_600_000_000,
    "hour": 3_600_000_000,
    "d": DAY_US,
    "day": DAY_US,
}

_DURATION = re.compile(r"\s*(\d+(?:\.\d+)?)?\s*([a-z]+?)s?\s*")


def duration_us(value: str | timedelta | int | float) -> int:
    """A length of time in whole microseconds; bare numbers are seconds."""
    if isinstance(value, timedelta):
        return value // timedelta(microseconds=1)
    if isinstance(value, (int, float)):
        return round(value * 1_000_000)
    text = value.lower()
    match = _DURATION.fullmatch(text) if text.strip() not in _UNIT_US else None
    number, unit = match.groups() if match else (None, text.strip())
    if unit not in _UNIT_US and unit + "s" in _UNIT_US:
        unit += "s"
    if unit not in _UNIT_US:
        raise ValueError(f"not a duration: {value!r}")
    return round(float(number or 1) * _UNIT_US[unit])


def raster_us(raster: str | timedelta | int | float) -> int:
    """Raster step; it must divide a day so that grids of all days line up."""
    step = duration_us(raster)
    if step <= 0 or DAY_US % step:
        raise ValueError(f"raster {raster!r} does not divide 24 hours")
    return step


def micros(t: Column | str) -> Column:
    return F.unix_micros(F.col(t) if isinstance(t, str) else t)


def bucket(us: Column, width: int) -> Column:
    """Number of the ``width``-wide time bucket that holds ``us``."""
    return F.call_function("div", us - F.pmod(us, F.lit(width)), F.lit(width))


def ceil_to(us: Column, step: int) -> Column:
    """Smallest multiple of ``step`` that is not before ``us``."""
    return us + F.pmod(-us, F.lit(step))
