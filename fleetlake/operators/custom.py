"""Named table functions that derive custom messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import source_address
from ..functions.geo import with_fence
from ..schema import SERIES_KEYS
from .chunks import DEFAULT_CHUNK, previous_row

# Speed (m/s) above which driven distance counts as high speed (fixed value).
HIGH_SPEED = 20


@dataclass(frozen=True)
class CustomContext:
    """What a custom function may use besides the rows."""

    keys: Sequence[str] = SERIES_KEYS
    t: str = "t"
    fences: Sequence[Mapping] = field(default_factory=tuple)
    width: int | str = DEFAULT_CHUNK


CustomFunction = Callable[[DataFrame, CustomContext], DataFrame]

_REGISTRY: dict[str, CustomFunction] = {}


def register_custom(name: str) -> Callable[[CustomFunction], CustomFunction]:
    """Make a ``DataFrame -> DataFrame`` function available to configs under ``name``."""

    def add(function: CustomFunction) -> CustomFunction:
        _REGISTRY[name] = function
        return function

    return add


def apply_custom(
    df: DataFrame, name: str, context: CustomContext | None = None, tag: str = "Message"
) -> DataFrame:
    """Run the function registered under ``name``; an unknown name changes nothing.

    The message tag, present for functions that need it, is dropped afterwards.
    """
    function = _REGISTRY.get(name)
    result = function(df, context or CustomContext()) if function else df
    return result.drop(tag)


def _signals_only(df: DataFrame, context: CustomContext, signals: Sequence[str]) -> DataFrame:
    return df.select(*context.keys, context.t, *signals).na.drop("all", subset=list(signals))


@register_custom("combine_dtcs")
def combine_codes(df: DataFrame, context: CustomContext) -> DataFrame:
    """Source address from the message name, and both parts of the code added up.

    Rows keep no order of their own: order is given where the table is written or read.
    """
    return df.withColumn("SA", source_address(F.col("Message"))).withColumn(
        "DM01_SPN_Final", F.col("DM01_SPN") + F.col("DM01_SPN_High")
    )


@register_custom("custom_geofences")
def custom_geofences(df: DataFrame, context: CustomContext) -> DataFrame:
    """The first fence around each position; without any fence it can't be told."""
    if not context.fences:
        raise ValueError("custom_geofences needs fences")
    return _signals_only(with_fence(df, context.fences), context, ["GeofenceId"])


@register_custom("delta_distance")
def delta_distance(df: DataFrame, context: CustomContext) -> DataFrame:
    """Distance since the previous row, in all and split by speed where speed is valid."""
    rows = previous_row(df, context.keys, ["DistanceTrip"], context.t, context.width)
    delta = F.col("DistanceTrip") - F.col("prev_DistanceTrip")
    valid = F.col("SpeedValid") == 1
    signals = ["DeltaDistance", "DeltaDistanceHighSpeed", "DeltaDistanceLowSpeed"]
    return _signals_only(
        rows.withColumns(
            {
                signals[0]: delta,
                signals[1]: F.when(valid & (F.col("Speed") > HIGH_SPEED), delta),
                signals[2]: F.when(valid & (F.col("Speed") <= HIGH_SPEED), delta),
            }
        ),
        context,
        signals,
    )


@register_custom("resample")
def keep_resampled(df: DataFrame, context: CustomContext) -> DataFrame:
    """Nothing further: exists to store a resampled or joined table."""
    return df
