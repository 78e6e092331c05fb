"""Document fingerprints by winnowing.

All k-grams of code points are hashed by doubling (hashes of 2, 4, 8 ... code points are made from
two halves), and the least hash of each window of w neighbouring k-grams is kept, the rightmost of
equal ones, with its position. Any passage of k + w - 1 code points that two texts share leaves a
common hash in both. Texts are fingerprinted in Arrow batches; what a text is compared with, the next
document, comes next in the same sorted partition, so whole texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from base64 import b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text

#: Code points of a k-gram, and k-grams of a window: shared passages of 31 code points are found.
K, W = 12, 20
#: The sort key of a k-gram: its hash above, its position, counted backwards, below.
POSITION_BITS = np.uint64(20)
_MASK = np.uint64((1 << 20) - 1)
#: Longer texts are hashed in overlapping pieces, so that positions in a key stay apart.
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Mixed 64-bit hashes of all k-grams; a shorter text is one gram."""
    k = min(k, len(points))
    power = points.astype(np.uint64) + np.uint64(1)  # hashes of 2**j code points
    done, size, total = 0, 1, None
    while True:
        if k & size:  # append this power of two to what is hashed already
            count = len(points) - done - size + 1
            if total is None:
                total = power[:count]
            else:
                total = total[:count] * np.uint64(pow(_BASE, size, 1 << 64)) + power[done : done + count]
            done += size
        if done == k:
            break
        power = power[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size:]
        size *= 2
    mixed = total ^ (total >> np.uint64(32))
    mixed = mixed * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def window_minima(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, by doubling; all of them if there are fewer."""
    w = min(w, len(values))
    size = 1
    while size * 2 <= w:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = w - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and positions of a text's fingerprint, by position; empty for no text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = gram_hashes(points, k)
    kept_hashes, kept_places = [], []
    for start in range(0, max(1, len(hashes) - w + 1), PIECE):
        piece = hashes[start : start + PIECE + w - 1]
        places = np.uint64(len(piece)) - np.arange(1, len(piece) + 1, dtype=np.uint64)
        keys = (piece & ~_MASK) | places
        least = window_minima(keys, w)
        least = least[np.r_[True, least[1:] != least[:-1]]]
        kept_hashes.append((least >> np.uint64(32)).astype(np.uint32))
        kept_places.append(start + len(piece) - 1 - (least & _MASK).astype(np.int64))
    hashes, places = np.concatenate(kept_hashes), np.concatenate(kept_places)
    places, first = np.unique(places, return_index=True)  # pieces overlap
    return hashes[first], places


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common hashes by all hashes of two sorted sets; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def printed(hashes: np.ndarray) -> str:
    """The hashes by position, 4 bytes each, in base 64."""
    return b64encode(hashes.astype("<u4").tobytes()).decode()


def fingerprint_documents(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """``doc_id``, ``hashes`` and ``positions`` of every text: a map over the scan, no shuffle."""
    rows = docs.select("doc_id", whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = [winnow(t, k, w) for t in batch.column(1).to_pylist()]
                hashes = pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64()))
                places = pa.array([p for _, p in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), hashes, places], ["doc_id", "hashes", "positions"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, hashes array<long>, positions array<long>")


#: A bucket has few rows while there are less than ``MANY_BUCKETS``, then up to ``FULL_BUCKET`` rows. The bounds are
#: numbers that the driver hands out, so a table of 20 billion rows gets a million of them.
BUCKET_ROWS, MANY_BUCKETS, FULL_BUCKET = 1000, 4096, 20_000


def in_order(docs: DataFrame) -> DataFrame:
    """Buckets of documents in descending order of doc_id, each with the head of the next one.

    ``bucket``, ``head`` (1 for a row lent by the next bucket), ``doc_id`` and ``text``. Buckets are
    ranges of doc_id between approximate quantiles, so texts need one shuffle by bucket; only the
    first document of each bucket is read again. Missing ids come last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    ids = rows.select("doc_id")
    count = ids.count()
    parts = max(1, min(MANY_BUCKETS, count // BUCKET_ROWS), count // FULL_BUCKET)
    shares = [i / parts for i in range(1, parts)]
    bounds = ids.agg(F.percentile_approx("doc_id", shares or [0.5], max(20 * MANY_BUCKETS, 4 * parts))).collect()[0][0] or []
    bounds = np.unique(np.array(bounds if shares else [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def bucket_of(doc_ids):
        numbers = np.full(len(doc_ids), len(bounds) + 1, np.int32)
        known = doc_ids.notna().to_numpy()
        numbers[known] = len(bounds) - np.searchsorted(bounds, doc_ids[known].to_numpy(np.int64), "left")
        return type(doc_ids)(numbers)

    dealt = rows.withColumn("bucket", bucket_of("doc_id"))
    first = ids.withColumn("bucket", bucket_of("doc_id")).groupBy("bucket").agg(F.max("doc_id").alias("first"))
    order = Window.orderBy("bucket")
    lent_to = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy()))
    first = first.select("first", F.col("bucket").alias("of"), lent_to.alias("lent_to"))
    heads = rows.join(F.broadcast(first), rows["doc_id"].eqNullSafe(F.col("first")))
    heads = heads.groupBy("of", "lent_to").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
    return dealt.select("bucket", F.lit(0).alias("head"), "doc_id", "text").unionByName(
        heads.select(F.col("lent_to").alias("bucket"), F.lit(1).alias("head"), "doc_id", "text")
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    The next document is the one of the next smaller doc_id, after the last the first; rows of equal
    id follow each other in order of text, rows without id come last. The edited text has its last
    floor(n_chars / 3) code points replaced by the first as many (or all) of the next document's.
    A missing text is empty; two empty fingerprints are alike (1). A lone document is its own next.
    """
    buckets = in_order(docs).repartition("bucket").sortWithinPartitions("bucket", "head", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                out = []
                for _, head, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    hashes, _ = winnow(text, k, w)
                    found = np.unique(hashes)
                    if last is not None:
                        out.append(_compared(*last, text, found, k, w))
                    last = None if head else (doc_id, text, hashes, found)
                yield pa.RecordBatch.from_pylist(out, schema=RESULT_ARROW)

    return buckets.select("bucket", "head", "doc_id", "text").mapInArrow(run, RESULT)


def _compared(doc_id, text: str, hashes: np.ndarray, found: np.ndarray, after: str, after_found: np.ndarray, k: int, w: int) -> dict:
    changed = len(text) // 3
    edited = text[: len(text) - changed] + after[:changed]
    edited_hashes, _ = winnow(edited, k, w)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": printed(hashes),
        "edited_fingerprint": printed(edited_hashes),
        "near_edited": likeness(found, np.unique(edited_hashes)),
        "near_next": likeness(found, after_found),
    }


RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(name, pa.string()) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(name, pa.float64()) for name in ("near_edited", "near_next")]
)
