"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


#: So many edges, counted before, are finished by one task (16 bytes each); more by stars.
FEW_EDGES = 200_000


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least ids over a bounded number of edges: labels fall along edges and to their labels' labels."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    low, high = (np.concatenate(p) for p in zip(*parts, strict=True))
    ids, places = np.unique(np.r_[low, high], return_inverse=True)
    a, b = places[: len(low)], places[len(low) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], ["id", "component"])


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the least id reachable) of every id on an edge (``a``, ``b``: long).

    Each step hangs neighbours on the least neighbour, found by partial aggregates, until only stars
    around the least ids are left, after about log steps. Edges are written after each step, so lost
    executors cost one step. Loops and repeated edges do no harm; ids without other ids are not returned.
    """
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    found = stored(ordered.distinct(), "edges")
    if found.count() <= FEW_EDGES:
        return stored(found.coalesce(1).mapInArrow(_finished, "id long, component long"), "components")
    before = None
    while True:
        both = found.unionByName(found.select(F.col("high").alias("low"), F.col("low").alias("high")))
        least = both.groupBy("low").agg(F.min("high").alias("least"))
        least = least.select(F.col("low").alias("id"), F.least("low", "least").alias("least"))
        # Large star: every larger neighbour hangs on the least one.
        large = found.join(least, F.col("low") == F.col("id")).select(F.col("least").alias("low"), "high")
        large = large.where("low <> high").distinct()
        # Small star: smaller neighbours, and the id itself, hang on the least of them.
        lower = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(lower, "high").select(F.col("least").alias("low"), F.explode(F.array("low", "high")).alias("high"))
        found = stored(small.where("low <> high").distinct(), "edges")
        now = found.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).collect()[0]
        if now == before:
            break
        before = now
    stars = found.select(F.col("high").alias("id"), F.col("low").alias("component"))
    centres = found.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
    return stars.unionByName(centres)
