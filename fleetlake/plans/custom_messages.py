"""Derived messages: select, resample and join or stack, apply a named function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import salt_of, salted
from ..operators.custom import CustomContext, apply_custom
from ..operators.resample import (
    grid_join,
    prefixed,
    resample_grid,
    signal_columns,
    stack_messages,
)
from ..schema import PATH_COLUMNS, SERIES_KEYS
from ..sources.configs import message_lists
from ..sources.lake import Lake, write_message

ALL = "ALL"


def wanted_messages(lake: Lake, config: Mapping) -> list[list[str]]:
    """The lists of input messages; each list gives rows of its own."""
    match_type, filtered = config["messages_match_type"], config.get("messages_filtered_list")
    if match_type == "equals":
        return message_lists(match_type, filtered)
    if match_type == "contains":
        return [[n for n in lake.names() if filtered in n]]
    if match_type == "all_messages":
        return [[ALL]]
    raise ValueError(f"unknown match type: {match_type}")


def _complete_files(rows: DataFrame, n: int, keys: Sequence[str], salts: int = 32) -> DataFrame:
    """Rows of the files that have all ``n`` messages.

    The complete files, one small row each, are repeated under each salt, so that a long file
    is checked by many tasks.
    """
    complete = (
        rows.select(*keys, "Message")
        .distinct()
        .groupBy(*keys)
        .count()
        .where(F.col("count") == n)
        .select(*keys)
    )
    return (
        rows.withColumn("_salt", salt_of(F.col("t"), salts))
        .join(salted(complete, salts), [*keys, "_salt"], "left_semi")
        .drop("_salt")
    )


def join_present(
    grids: Mapping[str, DataFrame],
    messages: Mapping[str, DataFrame],
    keys: Sequence[str] = SERIES_KEYS,
    salts: int = 32,
) -> DataFrame:
    """Per file, the inner grid join of whichever ``messages`` that file has.

    ``grids`` are the same messages resampled. One aggregate per (file, label) replaces a chain
    of joins: a label is complete if as many messages meet there as the file has. Signal names
    must differ between messages.
    """
    names = [c for df in grids.values() for c in signal_columns(df, keys)]
    if len(names) != len(set(names)):
        raise ValueError("joined messages share signal names; use a prefix")
    present = stack_messages({n: df.select(*keys) for n, df in messages.items()}, "_source")
    per_file = present.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_wanted"))
    merged = stack_messages(grids, None).groupBy(*keys, "t").agg(
        *(F.max(c).alias(c) for c in names), F.count(F.lit(1)).alias("_met")
    )
    return (
        merged.withColumn("_salt", salt_of(F.col("t"), salts))
        .join(salted(per_file, salts), [*keys, "_salt"])
        .where(F.col("_met") == F.col("_wanted"))
        .drop("_salt", "_met", "_wanted")
    )


def _inputs(lake: Lake, names: Sequence[str]) -> dict[str, DataFrame] | None:
    """The named messages, or None if one of them is nowhere in the lake."""
    frames = {n: lake.message(n) for n in names}
    return None if any(f is None for f in frames.values()) else frames


def input_rows(lake: Lake, config: Mapping, names: Sequence[str]) -> DataFrame | None:
    """Stacked or grid-joined input rows for one list of messages."""
    everything = list(names) == [ALL]
    if everything:
        found = {n: lake.message(n) for n in lake.names()}
        frames = {n: f for n, f in found.items() if f is not None}
    else:
        frames = _inputs(lake, names)
    if not frames:
        return None
    raster, prefix = config["raster"], config["prefix"]
    frames = {
        name: df.drop(*(c for c in PATH_COLUMNS if c not in SERIES_KEYS))
        for name, df in frames.items()
    }
    if not raster:
        named = {
            n: prefixed(df, n, signal_columns(df)) if prefix else df for n, df in frames.items()
        }
        stacked = stack_messages(named)
        if everything or len(frames) == 1:
            return stacked
        return _complete_files(stacked, len(frames), SERIES_KEYS)
    grids = {n: resample_grid(df, raster) for n, df in frames.items()}
    if everything:
        if prefix:
            grids = {n: prefixed(df, n, signal_columns(df)) for n, df in grids.items()}
        joined = join_present(grids, frames)
    else:
        joined = grid_join(grids, prefix=prefix)
    return joined.withColumn("Message", F.lit(list(frames)[-1]))


def custom_message(lake: Lake, config: Mapping, context: CustomContext | None = None) -> DataFrame | None:
    """Rows of one derived message, ready for ``write_message``."""
    results = [
        apply_custom(rows, config["function"], context)
        for rows in (input_rows(lake, config, names) for names in wanted_messages(lake, config))
        if rows is not None
    ]
    if not results:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)


def custom_messages(
    lake: Lake, configs: Sequence[Mapping], context: CustomContext | None = None
) -> dict[str, DataFrame]:
    """All derived messages by name. They read the lake as it is, never each other."""
    derived = {c["custom_message_name"]: custom_message(lake, c, context) for c in configs}
    return {name: df for name, df in derived.items() if df is not None}


def write_custom_messages(
    lake: Lake, configs: Sequence[Mapping], root: str, context: CustomContext | None = None
) -> list[str]:
    """Store all derived messages in the lake below ``root``; returns their names."""
    derived = custom_messages(lake, configs, context)
    for name, df in derived.items():
        write_message(df, root, name)
    return list(derived)
