"""Embedding whitening by incremental eigendecomposition.

Every partition keeps count, mean and the eigendecomposition of its scatter matrix. A vector moves
the mean and adds a rank-one term to the scatter: the new eigenvalues are the roots of a secular
equation, the new eigenvectors follow from them (``rank_one``). Eigenvalues that the vector does not
touch, or that are equal, are deflated first. The spectra of two partitions are combined in the same
way: one update for each direction of the second, one for the distance of the means.

Rounding errors of many updates are removed by one distributed Rayleigh-Ritz step: all vectors are
projected on the directions found, the small matrix of their products is summed over the table and
diagonalised, and its rotation gives the final directions, to double precision.

What tasks and driver hold is bounded by the square of the vectors' width. A vector costs a few
products of matrices of that width; copies within an Arrow batch cost one update together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import combined

#: Fixed values of the integer scale: x = floor(FACTOR * c) + SHIFT.
FACTOR, SHIFT = 1024.0, 100_000
#: Scaled entries are clamped to this size, so that sums of a batch are exact in 64 bits.
LARGEST = 10**15
COMPONENTS = 8
#: Vectors taken at once; their sums fit 64 bits.
ROWS = 2048
EPS = float(np.finfo(np.float64).eps)


# --- Eigendecomposition under rank-one changes -----------------------------------------------------


def _isolated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Rotates the directions of equal eigenvalues so that only the last of each group meets ``z``."""
    vectors, z = vectors.copy(), z.copy()
    starts = np.flatnonzero(np.append(True, np.diff(values) > near))
    for start, end in zip(starts, np.append(starts[1:], len(values)), strict=True):
        length = float(np.linalg.norm(z[start:end]))
        if end - start < 2 or length == 0.0:
            continue
        # A Householder reflection that maps this part of z onto its last axis.
        mirror = z[start:end].copy()
        sign = 1.0 if mirror[-1] >= 0 else -1.0
        mirror[-1] += sign * length
        mirror /= np.linalg.norm(mirror)
        part = vectors[:, start:end]
        vectors[:, start:end] = part - 2.0 * np.outer(part @ mirror, mirror)
        z[start:end] = 0.0
        z[end - 1] = -sign * length
    return vectors, z


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights / (poles - x)), and each pole's distance to each root.

    ``poles`` ascend and differ, ``weights`` are positive. Row i of the distances is poles - root i; it is
    formed from the pole nearest to the root, so that small distances keep all their digits.
    """
    count = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum() * (1 + 4 * EPS))
    width = ends - poles
    at_middle = 1.0 + (weights / (poles - (poles + width / 2)[:, None])).sum(1)
    right = (at_middle < 0) & (np.arange(count) < count - 1)
    origin = np.where(right, ends, poles)
    shifted = poles - origin[:, None]
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, width / 2)
    high[-1] = width[-1]
    if at_middle[-1] < 0:
        low[-1] = width[-1] / 2
    else:
        high[-1] = width[-1] / 2
    left_of = np.tri(count)
    x = (low + high) / 2
    first, second = poles - origin, ends - origin
    at = np.arange(count)  # roots still looked for
    for _ in range(80):
        here, left = x[at], left_of[at]
        inverse = 1.0 / (shifted[at] - here[:, None])
        slopes = inverse * inverse
        f = 1.0 + inverse @ weights
        size = 1.0 + inverse @ weights - 2.0 * ((inverse * left) @ weights)  # the sum of absolute terms
        search = np.abs(f) > 2 * EPS * count * size
        low[at], high[at] = np.where(f < 0, here, low[at]), np.where(f < 0, high[at], here)
        # Both sides' sums are replaced by one pole each; a quadratic gives the next point.
        below = (slopes * left) @ weights
        above = slopes @ weights - below
        d1, d2 = first[at] - here, second[at] - here
        a = (d1 + d2) * f - d1 * d2 * (below + above)
        b = d1 * d2 * f
        c = f - d1 * below - d2 * above
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            near = here + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        inside = np.isfinite(near) & (near > low[at]) & (near < high[at])
        moved = np.where(inside, near, (low[at] + high[at]) / 2)
        search &= moved != here
        at = at[search]
        if not len(at):
            break
        x[at] = moved[search]
    return origin + x, shifted - x[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, change: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of ``vectors diag(values) vectors' + weight change change'``."""
    z = vectors.T @ change
    length = float(np.sqrt(z @ z))
    if length == 0.0 or weight <= 0.0:
        return values, vectors
    z, rho = z / length, weight * length * length
    near = 8 * EPS * max(float(values[-1]), rho)
    if (np.diff(values) <= near).any():
        vectors, z = _isolated(values, vectors, z, near)
    keep = np.flatnonzero(rho * np.abs(z) > near)
    if not len(keep):  # lost in rounding
        return values, vectors
    poles, part = values[keep], z[keep]
    roots, distance = secular_roots(poles, rho * part * part)
    # The vector for which the computed roots are exact: its eigenvectors are orthogonal.
    apart = poles[:, None] - poles
    np.fill_diagonal(apart, -1.0)
    fitted = np.sqrt(np.abs(np.prod(distance / apart, axis=0))) * np.sign(part)
    turn = (fitted / distance).T
    turn /= np.sqrt((turn * turn).sum(0))
    values, vectors = values.copy(), vectors.copy()
    values[keep], vectors[:, keep] = roots, vectors[:, keep] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigendecomposition of the scatter (not divided by the count) of some vectors."""

    count: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray, copies: int) -> None:
        """``copies`` equal vectors more."""
        total = self.count + copies
        change = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, change, self.count * copies / total)
        self.mean = self.mean + change * (copies / total)
        self.count = total

    def merge(self, other: Spectrum) -> None:
        """The vectors of ``other`` more, known by their spectrum."""
        total = self.count + other.count
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        change = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, change, self.count * other.count / total)
        self.mean = self.mean + change * (other.count / total)
        self.count = total


# --- Over tables -------------------------------------------------------------------------------------


def _whole(vector: Column) -> Column:
    """Whether a vector has neither missing nor non-finite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id`` and ``vector`` (doubles) of the rows that count, and their width."""
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", vector.alias("vector")).where(_whole(F.col("vector")) & (F.size("vector") > 0))
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    return rows.where(F.size("vector") == width), width


def _scaled(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors, a bounded number of rows at a time."""
    at = batch.schema.get_field_index("vector")
    for start in range(0, batch.num_rows, ROWS):
        piece = batch.slice(start, ROWS)
        flat = piece.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        scaled = np.clip(np.floor(FACTOR * flat), -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT
        yield piece.column(0), scaled


def _spectra(rows: DataFrame, width: int) -> dict | None:
    """Count, exact sums and spectrum of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = Spectrum.empty(width), [0] * width
        for batch in batches:
            for _, x in _scaled(batch, width):
                sums = [a + int(b) for a, b in zip(sums, x.sum(0), strict=True)]
                distinct, copies = np.unique(x, axis=0, return_counts=True)
                for vector, n in zip(distinct.astype(np.float64), copies.tolist(), strict=True):
                    own.add(vector, n)
        if own.count:
            yield pa.RecordBatch.from_pylist([_row(own, sums)], schema=_SPECTRUM)

    def merge(parts: list[dict]) -> dict:
        own, sums = _of_row(parts[0])
        for part in parts[1:]:
            other, more = _of_row(part)
            own.merge(other)
            sums = [a + b for a, b in zip(sums, more, strict=True)]
        return _row(own, sums)

    parts = rows.select("vector").mapInArrow(run, "count long, sums array<string>, mean array<double>, spread array<double>, axes array<double>")
    return combined(parts.withColumn("slot", F.spark_partition_id()), merge)


_SPECTRUM = pa.schema(
    [
        ("count", pa.int64()),
        ("sums", pa.list_(pa.string())),
        ("mean", pa.list_(pa.float64())),
        ("spread", pa.list_(pa.float64())),
        ("axes", pa.list_(pa.float64())),
    ]
)


def _row(own: Spectrum, sums: list[int]) -> dict:
    return {
        "count": own.count,
        "sums": [str(s) for s in sums],  # of any size
        "mean": own.mean.tolist(),
        "spread": own.values.tolist(),
        "axes": own.vectors.ravel().tolist(),
    }


def _of_row(row: dict) -> tuple[Spectrum, list[int]]:
    width = len(row["mean"])
    axes = np.array(row["axes"]).reshape(width, width)
    return Spectrum(row["count"], np.array(row["mean"]), np.array(row["spread"]), axes), [int(s) for s in row["sums"]]


def _products(rows: DataFrame, width: int, count: int, sums: list[int], axes: np.ndarray) -> np.ndarray:
    """Covariance of all vectors in the coordinates ``axes`` (columns), centred before multiplying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((axes.shape[1], axes.shape[1]))
        for batch in batches:
            for _, x in _scaled(batch, width):
                seen = _centred(x, count, sums) @ axes
                total += seen.T @ seen
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["total"])

    def merge(parts: list[dict]) -> dict:
        return {"total": np.sum([p["total"] for p in parts], axis=0).tolist()}

    parts = rows.select("vector").mapInArrow(run, "total array<double>").withColumn("slot", F.spark_partition_id())
    whole = combined(parts, merge)["total"]
    return np.array(whole).reshape(axes.shape[1], axes.shape[1]) / count


def _exact(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """count * x - sums, in 64 bits where all of it fits, else in whole numbers of any size."""
    most = int(np.abs(x).max(initial=0)) * count + max(map(abs, sums), default=0)
    if most < 2**62:
        return x * count - np.array(sums, np.int64)
    return x.astype(object) * count - np.array(sums, object)


def _centred(x: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    return _exact(x, count, sums).astype(np.float64) / count


@dataclass
class Whitening:
    """What whitens vectors of one width: ``axes`` (columns) over the square roots of ``values``."""

    count: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.count, self.sums) @ self.axes / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Squared distances from the mean, times the squared count; None beyond 64 bits."""
        moved = _exact(x, self.count, self.sums)
        if moved.dtype != object and int(np.abs(moved).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (moved * moved).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in moved]
        return [v if v < 2**63 else None for v in exact]


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of all ``usable`` vectors; None without any."""
    found = _spectra(rows, width) if width else None
    if found is None:
        return None
    spectrum, sums = _of_row(found)
    axes, _ = np.linalg.qr(spectrum.vectors[:, ::-1])
    covariance = _products(rows, width, spectrum.count, sums, axes)
    values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    values, axes = values[::-1], axes @ turn[:, ::-1]
    kept = int((values[:components] > width * EPS * max(values[0], 0.0)).sum())
    made = Whitening(spectrum.count, sums, values[:kept], axes[:, :kept], values[:kept] / (trace or 1.0), 0.0)
    if kept:
        seen = _products(rows, width, made.count, sums, made.axes / np.sqrt(made.values))
        made.identity_error = float(np.abs(seen - np.eye(kept)).max())
    return made


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    One row for each usable vector and component, numbered from 1 by falling eigenvalue. Left out are
    vectors that are null, empty, hold null or non-finite entries, or have another width than most
    (of equally frequent widths the larger counts). Scaled entries are clamped to 10^15. Components
    without variance cannot be whitened and are left out: a table of equal vectors, or of one, gives no
    rows, like an empty table. Repeated rows and ids count as often as they come; other columns are
    not looked at. ``deviation`` is null where it exceeds 64 bits.
    """
    vectors, width = usable(rows)
    model = fit(vectors, width, components)
    schema = T.StructType(
        [
            T.StructField("vec_id", vectors.schema["vec_id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = len(model.values)
        for batch in batches:
            for ids, x in _scaled(batch, width):
                rows, of_row = len(x), np.repeat(np.arange(len(x)), kept)
                arrays = [
                    ids.take(pa.array(of_row)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * kept, model.count)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(of_row)),
                    pa.array(model(x).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * kept, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return vectors.mapInArrow(run, schema)
