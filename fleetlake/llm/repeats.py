"""Removal of repeated passages by minimizer sampling and a hash join, in place of prefix doubling.

Prefix doubling ranks every position by its first k bytes and the rest by pairs of ranks at growing
offsets. Here nothing is ranked and there are no rounds: positions are sampled by content. Every string
of ``length`` bytes contains the least (hashed) ``GRAM``-byte string among those it holds, so equal
strings are sampled at the same place, and meet by hash:

1. by ``GRAM`` bytes, whose hashes are put together from those of 2, 4, 8 ... bytes. Chunks of documents
   send them to buckets, which sort them and answer with one bit each: shared with another document, or
   unique and dropped.
2. by ``length`` bytes around the positions that are left, for each offset of the position in the
   string, with one hash of the whole string. The earliest document of each equal run keeps it; the
   others learn the bytes to remove.

Texts are shuffled once, by chunk; all three passes over the chunks read that same exchange. Requests
and answers are packed per (chunk, bucket), and a bucket is streamed twice through a spool file, so
that a passage in a third of all documents costs bytes, not memory. Hashes only choose what to compare:
strings count as equal after their bytes were compared.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .winnowing import gram_hashes, window_minima

#: Bytes of a sampled string.
GRAM = 16
#: Bytes of text in a chunk, about; and positions that are sampled at a time.
CHUNK_BYTES, PIECE = 2 << 20, 1 << 19
#: Bytes of text whose requests share a bucket, about, where that gives more buckets than the shuffle has tasks.
BUCKET_BYTES = 256 << 20
_LOW = np.uint64((1 << 20) - 1)
_REQUEST = np.dtype([("low", "<u4"), ("high", "u1")])


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpack(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


class Chunk:
    """The documents of a chunk as one byte array, in an order that depends on the rows alone."""

    def __init__(self, table: pa.Table):
        rows = sorted(
            zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True),
            key=lambda r: (r[0] is None, r[0] or 0, r[1]),
        )
        self.ids = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        self.numbers = np.array([-1 if i is None else i for i in self.ids], np.int64)
        self.known = np.array([i is not None for i in self.ids], bool)

    def sampled(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, the rows they are in, and hashes of the ``GRAM`` bytes there."""
        window = length - GRAM + 1
        found_places, found_hashes = [], []
        for start in range(0, max(0, len(self.bytes) - length + 1), PIECE):
            hashes = gram_hashes(self.bytes[start : start + PIECE + length - 1], GRAM)
            places = np.uint64(len(hashes)) - np.arange(1, len(hashes) + 1, dtype=np.uint64)
            least = window_minima((hashes & ~_LOW) | places, window)
            first = np.arange(start, start + len(least))
            row = np.searchsorted(self.ends, first, "right")
            whole = (first + length <= self.ends[row]) & self.known[row]
            least = least[whole]
            least = least[np.r_[True, least[1:] != least[:-1]]] if len(least) else least
            places = len(hashes) - 1 - (least & _LOW).astype(np.int64)
            found_places.append(start + places)
            found_hashes.append(hashes[places])
        if not found_places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        places, first = np.unique(np.concatenate(found_places), return_index=True)
        return places, np.searchsorted(self.ends, places, "right"), np.concatenate(found_hashes)[first]


def _by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets with the indices of their hashes, in order."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


REQUESTS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("request", pa.binary())])


def _requests(table: pa.Table, length: int, buckets: int) -> pa.Table:
    """Hashes of the chunk's sampled positions: 39 bits, and whether two of its documents have it."""
    chunk = Chunk(table)
    places, rows, hashes = chunk.sampled(length)
    number = table.column("chunk")[0].as_py()
    docs = chunk.numbers[rows]
    order = np.lexsort((docs, hashes))
    same = hashes[order][1:] == hashes[order][:-1]
    groups = np.cumsum(np.r_[0, ~same])
    crossed = np.zeros(groups[-1] + 1 if len(order) else 0, bool)
    crossed[groups[1:][same & (docs[order][1:] != docs[order][:-1])]] = True
    shared = np.zeros(len(hashes), bool)
    if len(order):
        shared[order] = crossed[groups]
    out = []
    for bucket, index in _by_bucket(hashes, buckets):
        key = (hashes[index] // np.uint64(buckets) & np.uint64((1 << 39) - 1)) << np.uint64(1) | shared[index].astype(np.uint64)
        packed = np.empty(len(key), _REQUEST)
        packed["low"], packed["high"] = key & np.uint64(0xFFFFFFFF), key >> np.uint64(32)
        out.append({"bucket": bucket, "chunk": number, "request": packed.tobytes()})
    return _table(out, REQUESTS)


def _streamed_twice(first: Callable, between: Callable, second: Callable, schema: pa.Schema) -> Callable:
    """A map over rows (bucket, chunk, request) sorted by bucket.

    ``first`` takes each request into a list, ``between`` makes of the list what ``second`` needs
    to answer each request. In between the requests wait in an unlinked file.
    """

    def answers(known: list, spool, bucket: int) -> Iterator[pa.RecordBatch]:
        found = between(known)
        spool.seek(0)
        out = []
        while True:
            try:
                chunk, request = pickle.load(spool)
            except EOFError:
                break
            answer = second(found, request)
            if answer is not None:
                out.append({"bucket": bucket, "chunk": chunk, "answer": answer})
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, spool = None, [], None
        for batch in batches:
            for bucket, chunk, request in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    if spool is not None:
                        yield from answers(known, spool, current)
                        spool.close()
                    current, known, spool = bucket, [], tempfile.TemporaryFile()
                first(known, request)
                pickle.dump((chunk, request), spool)
        if spool is not None:
            yield from answers(known, spool, current)
            spool.close()

    return run


ANSWERS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("answer", pa.binary())])
ANSWERS_SQL = "bucket int, chunk long, answer binary"


def _keys(request: bytes) -> tuple[np.ndarray, np.ndarray]:
    packed = np.frombuffer(request, _REQUEST)
    key = packed["low"].astype(np.uint64) | packed["high"].astype(np.uint64) << np.uint64(32)
    return key >> np.uint64(1), (key & np.uint64(1)).astype(bool)


def _note_keys(known: list, request: bytes) -> None:
    keys, crossed = _keys(request)
    known.append(np.unique(keys))
    if crossed.any():
        known.append(np.unique(keys[crossed]))  # once more: as if another chunk had it


def _shared_keys(known: list) -> np.ndarray:
    keys = np.sort(np.concatenate(known))
    return np.unique(keys[1:][keys[1:] == keys[:-1]])


def _found(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def _shared_bits(shared: np.ndarray, request: bytes) -> bytes | None:
    bits = _found(_keys(request)[0], shared)
    return np.packbits(bits).tobytes() if bits.any() else None


def _contexts(docs: pa.Table, answers: pa.Table, length: int, buckets: int) -> pa.Table:
    """For each shared position all bytes that strings of ``length`` around it can have."""
    out = []
    if docs.num_rows and answers.num_rows:
        chunk = Chunk(docs)
        places, rows, hashes = chunk.sampled(length)
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("answer").to_pylist(), strict=True))
        side = length - GRAM
        padded = np.r_[np.zeros(side, np.uint8), chunk.bytes, np.zeros(length, np.uint8)]
        views = np.lib.stride_tricks.sliding_window_view(padded, side + length)
        number = docs.column("chunk")[0].as_py()
        for bucket, index in _by_bucket(hashes, buckets):
            if bucket not in bits:
                continue
            index = index[np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(index)).astype(bool)]
            place, row = places[index], rows[index]
            left = np.minimum(place - chunk.starts[row], side)
            right = np.minimum(chunk.ends[row] - place - GRAM, side)
            context = views[place].copy()
            column = np.arange(side + length)
            context[(column < side - left[:, None]) | (column >= side + GRAM + right[:, None])] = 0
            request = pickle.dumps([_pack(a) for a in (context, left.astype(np.uint8), right.astype(np.uint8), chunk.numbers[row], place)])
            out.append({"bucket": bucket, "chunk": number, "request": request})
    return _table(out, REQUESTS)


def _opened(request: bytes, length: int) -> tuple[np.ndarray, ...]:
    context, left, right, docs, places = pickle.loads(request)
    width = 2 * length - GRAM
    return (
        _unpack(context, np.uint8).reshape(-1, width),
        _unpack(left, np.uint8).astype(np.int64),
        _unpack(right, np.uint8).astype(np.int64),
        _unpack(docs, np.int64),
        _unpack(places, np.int64),
    )


def _context_keys(context: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a context."""
    width = -(-(context.shape[1] + 2) // 8) * 8
    words = np.zeros((len(context), width), np.uint8)
    words[:, : context.shape[1]] = context
    words[:, -2], words[:, -1] = left, right
    words = words.view("<u8")
    keys = []
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        key = np.full(len(words), seed, np.uint64)
        for i in range(words.shape[1]):
            key = (key ^ words[:, i]) * np.uint64(seed)
            key ^= key >> np.uint64(29)
        keys.append(key)
    return keys[0], keys[1]


class _Contexts:
    """The distinct contexts of a bucket, each with its smallest doc_id, and what is repeated in it."""

    def __init__(self, known: list, length: int):
        one, two, docs = (np.concatenate([k[i] for k in known]) for i in (0, 1, 4))
        context, left, right = (np.concatenate([k[i] for k in known]) for i in (2, 3, 5))
        order = np.lexsort((docs, two, one))
        new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
        order = order[new]
        self.one, self.two, self.docs = one[order], two[order], docs[order]
        self.low = np.full(len(order), 127, np.int64)
        self.high = np.full(len(order), -1, np.int64)
        self._mark(context[order], left[order], right[order], length)

    def _mark(self, context: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> None:
        """``low`` and ``high``: least and largest offset of a string that a smaller document has too."""
        side = length - GRAM
        gram = np.ascontiguousarray(context[:, side : side + GRAM]).view("<u8")
        group = gram[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ gram[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        values, inverse, counts = np.unique(group, return_inverse=True, return_counts=True)
        several = np.flatnonzero(counts[inverse] > 1)
        several = several[np.argsort(self.docs[several], kind="stable")]
        context, left, right, docs = context[several], left[several], right[several], self.docs[several]
        for a in range(0, side + 1):
            offset = side - a
            valid = np.flatnonzero((offset <= left) & (offset >= side - right))
            strings = context[valid, a : a + length]
            first = _first_equal(strings)
            repeated = several[valid[docs[valid] > docs[valid[first]]]]
            self.low[repeated] = np.minimum(self.low[repeated], offset)
            self.high[repeated] = np.maximum(self.high[repeated], offset)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.one, one)
        while (wrong := self.two[at] != two).any():
            at[wrong] += 1
        return at


def _first_equal(strings: np.ndarray) -> np.ndarray:
    """For each row the first row with equal bytes: by hash, checked by bytes, else by bytes alone."""
    if not len(strings):
        return np.zeros(0, np.int64)
    width = strings.shape[1]
    power = strings.astype(np.uint64) + np.uint64(1)
    weights = np.ones(width, np.uint64)
    np.cumprod(np.full(width - 1, 0x9E3779B97F4A7C15, np.uint64), out=weights[1:])
    hashes = power @ weights
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    first = first[inverse]
    if not np.array_equal(strings, strings[first]):
        whole = np.ascontiguousarray(strings).view(f"V{width}").ravel()
        _, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
        first = first[inverse]
    return first


def _note_contexts(known: list, request: bytes, length: int) -> None:
    context, left, right, docs, _ = _opened(request, length)
    one, two = _context_keys(context, left, right)
    order = np.lexsort((docs, two, one))
    new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    i = order[new]
    known.append((one[i], two[i], context[i], left[i], docs[i], right[i]))


def _spans(found: _Contexts, request: bytes, length: int) -> bytes | None:
    """Bytes to remove around each position: all strings of an equal context, or the marked ones."""
    context, left, right, docs, places = _opened(request, length)
    at = found.find(*_context_keys(context, left, right))
    later = docs > found.docs[at]
    low = np.where(later, length - GRAM - right, found.low[at])
    high = np.where(later, left, found.high[at])
    repeated = low <= high
    if not repeated.any():
        return None
    return pickle.dumps([_pack(places[repeated] - high[repeated]), _pack((places - low + length)[repeated])])


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())]
)
RESULT_SQL = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"


def _cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The chunk's documents without their spans."""
    if not docs.num_rows:
        return _table([], RESULT)
    chunk = Chunk(docs)
    edges = np.zeros(len(chunk.bytes) + 1, np.int64)
    for answer in answers.column("answer").to_pylist():
        starts, stops = (_unpack(blob, np.int64) for blob in pickle.loads(answer))
        np.add.at(edges, starts, 1)
        np.add.at(edges, stops, -1)
    gone = np.cumsum(edges)[:-1] > 0
    out = []
    for doc_id, text, start, end in zip(chunk.ids, chunk.texts, chunk.starts, chunk.ends, strict=True):
        own = gone[start:end]
        if own.any():
            turns = np.flatnonzero(np.diff(np.r_[False, own, False]))
            spans = [{"start": a, "stop": b} for a, b in turns.reshape(-1, 2).tolist()]
            text, size = chunk.bytes[start:end][~own].tobytes(), len(text)
        else:
            spans, size = [], len(text)
        out.append({"doc_id": doc_id, "n_bytes": size, "spans": spans, "kept": text})
    return _table(out, RESULT)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Every document without the bytes that a string of ``length`` bytes shares with a smaller doc_id.

    Texts are UTF-8 bytes. A byte goes if it lies in a string of ``length`` bytes that also starts in a
    document of smaller doc_id; all texts are taken as they came in. Returns ``doc_id``, ``n_bytes``,
    ``spans`` (maximal removed runs) and ``kept`` (the bytes left). A missing text is empty. Rows
    without doc_id are returned whole and count for no other row; rows of one doc_id don't count for each other.
    """
    if length < 2 * GRAM or length >= 127:
        raise ValueError(f"lengths from {2 * GRAM} to 126 are supported")
    spark = docs.sparkSession
    text = whole_text().cast("binary")
    total = docs.agg(F.sum(F.octet_length(text))).collect()[0][0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    # A task holds the requests of one bucket at a time, so buckets grow in number, not in size.
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    place: Column = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), text))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.pmod(place, F.lit(chunks)).alias("chunk"))
    base = base.repartition("chunk")

    def dealt(requests: DataFrame) -> DataFrame:
        return requests.repartition("bucket").sortWithinPartitions("bucket", "chunk").select("bucket", "chunk", "request")

    requests = base.groupBy("chunk").applyInArrow(lambda t: _requests(t, length, buckets), "bucket int, chunk long, request binary")
    shared = dealt(requests).mapInArrow(_streamed_twice(_note_keys, _shared_keys, _shared_bits, ANSWERS), ANSWERS_SQL)
    contexts = (
        base.groupBy("chunk")
        .cogroup(shared.groupBy("chunk"))
        .applyInArrow(lambda d, a: _contexts(d, a, length, buckets), "bucket int, chunk long, request binary")
    )
    spans = dealt(contexts).mapInArrow(
        _streamed_twice(
            lambda known, r: _note_contexts(known, r, length),
            lambda known: _Contexts(known, length),
            lambda found, r: _spans(found, r, length),
            ANSWERS,
        ),
        ANSWERS_SQL,
    )
    return base.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(_cut, RESULT_SQL)
