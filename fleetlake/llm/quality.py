"""Quality classifier by positive-unlabelled learning.

A logistic model is fitted to the non-negative unbiased risk: trusted positives weigh by the class
prior, unlabelled texts count as negative, and what the positives among them add is subtracted again, but
never below zero. The prior is the share of positives among the labelled training rows. Its margins are
then calibrated on the labelled training rows. Features come from the text alone. The fit sees bounded
samples, drawn by a digest of the ids; every text is scored whole, in one map over the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, id_digest, whole_text

#: Most labelled and most unlabelled rows that the fit sees.
LABELLED, UNLABELLED = 10_000, 10_000
#: Texts from this score on are predicted to be good.
THRESHOLD = 0.7
_SYMBOLS = re.compile(rb"[^\sA-Za-z0-9\x80-\xff]+")


def features(text: str) -> np.ndarray:
    """What the model sees of a text: byte shares, word repetition, line shape, compressibility."""
    data = text.encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = max(1, len(words))
    distinct = set(words)
    pairs = {*zip(words, words[1:], strict=False)}
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line for line in data.split(b"\n") if line]
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    packed = len(zstandard.ZstdCompressor(level=1).compress(data)) if data else 0
    runs = _SYMBOLS.findall(data)
    long_runs = sum(len(r) for r in runs if len(r) > 1)
    shape = [
        np.log1p(len(data)),
        np.log1p(len(words)),
        size / n / 10,
        len(distinct) / n,
        len(pairs) / n,
        same / n,
        np.log1p(1000 * same / n),
        upper / max(1, upper + lower),
        np.sqrt(upper / max(1, upper + lower)),
        sum(map(bytes.isupper, words)) / n,
        len(runs) / n,
        np.log1p(1000 * long_runs / size),
        packed / size,
        np.log1p(size / max(1, packed)),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(size / max(1, len(lines))),
        sum(map(len, distinct)) / max(1, len(distinct)) / 10,
        float(not words),
    ]
    shares = counts / size
    return np.concatenate([shape, np.sqrt(shares[9:127]), [shares[128:].sum()]]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Standardised features, a linear margin, and the calibration of the margin."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return _sigmoid(self.slope * z + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    x, first, second = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        g = gradient(x)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        x -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return x


def fit(positive: np.ndarray, unlabelled: np.ndarray, labelled: np.ndarray, labels: np.ndarray, steps: int = 400) -> Model:
    """The model of least non-negative PU risk, calibrated on ``labelled``."""
    prior = (labels.sum() + 1.0) / (len(labels) + 2.0)
    every = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float32) for x in (positive, unlabelled))
    ridge = 1e-2

    def gradient(w: np.ndarray) -> np.ndarray:
        w = w.astype(np.float32)
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        # Logistic loss: -log sigmoid(z) for positives, -log sigmoid(-z) for negatives.
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        as_positive = -prior * _sigmoid(-zp) / len(zp)
        as_negative_p, as_negative_u = prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
        if negative >= 0:
            gp, gu = as_positive - as_negative_p, as_negative_u
        else:  # the negative part overfits: walk back out of it
            gp, gu = as_negative_p, -as_negative_u
        return np.append(gp @ p + gu @ u + ridge * w[:-1], gp.sum() + gu.sum())

    w = _adam(gradient, np.zeros(p.shape[1] + 1), steps, 0.05)
    z = np.clip((labelled - mean) / scale, -8, 8) @ w[:-1] + w[-1]

    def calibration(c: np.ndarray) -> np.ndarray:
        error = _sigmoid(c[0] * z + c[1]) - labels
        return np.array([(error * z).mean() + 1e-3 * (c[0] - 1), error.mean()])

    slope, shift = _adam(calibration, np.array([1.0, 0.0]), 600, 0.03) if len(labels) and 0 < labels.mean() < 1 else (1.0, 0.0)
    return Model(mean, scale, w[:-1], float(w[-1]), float(max(slope, 1e-3)), float(shift))


def fold(name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; fold 2 is held out. A missing id is empty text."""
    return (F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % 4).cast("int")


def _vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, label and features of a bounded sample, computed on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tolist() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float32()))], ["kind", "label", "x"])

    rows = docs.select("kind", "label", whole_text().alias("text")).mapInArrow(run, "kind int, label int, x array<float>").toArrow()
    width = len(features(""))
    x = np.array(rows.column("x").to_pylist(), np.float32).reshape(-1, width)
    return rows.column("kind").to_numpy(), rows.column("label").to_numpy(), x


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> Model | None:
    """The model of ``labels.quality`` (1: trusted positive), from rows outside the held-out fold.

    None without any positive. Repeated labels of an id count once, as 1 if any is.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 2))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    known = known.orderBy(id_digest(), "doc_id").limit(labelled).select("doc_id", F.lit(0).alias("kind"), "label")
    web = docs.where(F.col("doc_id").isNotNull() & (fold() != 2)).select("doc_id")
    web = web.orderBy(F.md5(F.concat(F.lit("web"), F.col("doc_id").cast("string"))), "doc_id").limit(unlabelled)
    drawn = known.unionByName(web.select("doc_id", F.lit(1).alias("kind"), F.lit(0).alias("label")))
    # At most labelled + unlabelled ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    kinds, marks, x = _vectors(sample)
    positive = x[(kinds == 0) & (marks == 1)]
    if not len(positive):
        return None
    return fit(positive, x[kinds == 1], x[kinds == 0], marks[kinds == 0].astype(np.float64))


def _scored(rows: DataFrame, names: list[str], text, model: Model | None) -> DataFrame:
    """The first columns of ``rows``, those of ``names``, with ``score`` and ``predicted``; ``text`` takes
    the texts from an Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                if model is None:
                    scores = np.ones(batch.num_rows)
                else:
                    scores = model.scores(np.array([features(t or "") for t in text(batch).to_pylist()]))
                predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(scores), predicted], [*names, "score", "predicted"])

    schema = T.StructType([*rows.schema.fields[: len(names)], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every text; a map, no shuffle.

    A missing text is scored as an empty one. Without a model, nothing is known against any text: its
    score is 1. Equal texts get equal scores; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", (fold() == 2).alias("held_out"), whole_text().alias("text"))
    return _scored(rows, ["doc_id", "held_out"], lambda batch: batch.column(2), model)


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns."""
    at = docs.columns.index("text")
    scored = _scored(carried(docs), ["whole"], lambda batch: batch.column(0).field(at), train(docs, labels))
    return scored.where("predicted = 1").select("whole.*")
