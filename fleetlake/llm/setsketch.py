"""MinHash near-dedup with SetSketch registers.

Words are hashed from prefix sums over a batch of texts, shingles from words. A sketch's registers are
truncated minima on an exponential scale: mergeable (register-wise maximum), and equal in two sketches
with a probability near the similarity of their sets. Bands of registers are bucketed; what shares a bucket is estimated by
maximum likelihood over all registers jointly with the known set sizes, and confirmed on the full sets.

Pairs within a bucket are not all looked at. Documents with equal sets are one. Each is first compared
with the least id of its buckets; then, turn by turn, those outside the main component of a bucket
with changing pivots of it, as long as that links a good share of them. The last step compares all that
share a bucket, are not in one component yet, and have enough shingles that others have too: what a
set has alone is in no intersection. Large components are compared block by block. So a group of near copies costs a few comparisons
per document, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import carried, whole_text
from .components import components

#: Registers, and rows of a band. At similarity 0.8 a pair shares none of the 40 bands with a
#: probability of 7e-10.
REGISTERS, ROWS = 160, 4
#: Scale of the registers: base, rate and largest value, as is usual for 16 bits.
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 2
#: A pair is not confirmed on its sets only if the likelihood speaks against the threshold by this log ratio.
AGAINST = 30.0
#: Members that a document is compared with in a turn, and the share of links that makes another turn worthwhile.
PIVOTS, WORTHWHILE = 4, 0.1
#: Components with more open members are compared in blocks of so many.
BLOCK = 256
#: Ids up to this many are broadcast to pick texts; beyond that Spark joins by id.
BROADCAST_IDS = 1_000_000
#: Bytes of text that are hashed at a time, and texts at most.
BATCH_BYTES, BATCH_TEXTS = 1 << 19, 512

_B, _C = 0xD1342543DE82EF95, 0xA0761D6478BD642F
_WORD = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random codes of bytes, and multipliers and shifts of the registers, which take the upper half of a hash."""
    codes = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    seeds = (_mixed(np.arange(1000, 1000 + 2 * REGISTERS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    return codes, seeds[:REGISTERS] | np.uint32(1), seeds[REGISTERS:]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for base in (_B, pow(_B, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of ``words`` neighbouring words for each text.

    A-Z are lower-cased, words are what lies between white space. A text of fewer words is one
    shingle, one without words has none.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    stops = np.cumsum(lengths)
    lower = np.where((joined >= 65) & (joined <= 90), joined + 32, joined)
    blank = _SPACE[lower]
    turns = np.flatnonzero(np.diff(np.r_[True, blank]))
    starts, ends = turns[::2], turns[1::2]  # the last byte is blank, so each word ends
    size = 1 << max(20, int(len(joined)).bit_length())  # of one size but for very long texts
    up, down = _powers(size)
    sums = np.r_[np.uint64(0), np.cumsum(_constants()[0][lower] * up[: len(lower)], dtype=np.uint64)]
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = _mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(_C))
    first = np.searchsorted(starts, stops - lengths)
    last = np.searchsorted(starts, stops)
    grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        grams = grams * np.uint64(_B) + hashes[i : i + len(grams)]
    grams = _mixed(grams)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            total = np.uint64(b - a)
            for h in hashes[a:b]:
                total = np.uint64((int(total) * _B + int(h)) & _WORD)
            out.append(_mixed(np.array([total], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """A sketch for each of several non-empty sets: 1 - log_b of the least exponential number, rounded down, truncated."""
    if not sets:
        return np.zeros((0, REGISTERS), np.uint16)
    _, factors, shifts = _constants()
    hashes = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least, part = np.empty((REGISTERS, len(sets)), np.uint32), np.empty_like(hashes)
    for i in range(REGISTERS):
        np.multiply(hashes, factors[i], out=part)
        part += shifts[i]
        np.minimum.reduceat(part, starts, out=least[i])
    uniform = (least.T.astype(np.float64) + 1.0) / 2.0**32
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1.0 - np.log(exponential) / np.log(BASE)), 0, LARGEST + 1).astype(np.uint16)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set."""
    return registers_of([hashes])[0]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def bands(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of register values, of one sketch or of several."""
    parts = sketch.astype(np.uint64).reshape(*sketch.shape[:-1], REGISTERS // ROWS, ROWS)
    keys = np.arange(1, REGISTERS // ROWS + 1, dtype=np.uint64) * np.uint64(_C)
    for i in range(ROWS):
        keys = _mixed(keys * np.uint64(_B) + parts[..., i])
    return keys


def log_likelihood(j: np.ndarray | float, above: np.ndarray | int, below: np.ndarray | int, n_a: np.ndarray | int, n_b: np.ndarray | int) -> np.ndarray:
    """Of ``above`` registers larger in sketch a, ``below`` larger in b, the others equal, at similarity j."""
    u = n_a / (n_a + n_b)
    j = np.minimum(j, np.minimum(u / (1 - u), (1 - u) / u))

    def larger(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0.0) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = larger(u - (1 - u) * j), larger((1 - u) - u * j)
    tiny = 1e-12
    return above * np.log(np.maximum(p, tiny)) + below * np.log(np.maximum(q, tiny)) + (REGISTERS - above - below) * np.log(np.maximum(1 - p - q, tiny))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray | int, n_b: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest similarity of two sketched sets of known sizes, and its log likelihood; or of many pairs, a row each."""
    above, below = (a > b).sum(-1), (a < b).sum(-1)
    high = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    low = np.zeros_like(high)
    for _ in range(40):  # the likelihood has one peak
        x, y = low + (high - low) * 0.382, low + (high - low) * 0.618
        up = log_likelihood(x, above, below, n_a, n_b) < log_likelihood(y, above, below, n_a, n_b)
        low, high = np.where(up, x, low), np.where(up, high, y)
    best = (low + high) / 2
    return best, log_likelihood(best, above, below, n_a, n_b)


def _may_be_similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches, a row each, don't speak clearly against the threshold."""
    may = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    above, below = (a > b).sum(1), (a < b).sum(1)
    # Few registers differ: no estimate can speak against the threshold.
    some = np.flatnonzero(may & (above + below > REGISTERS // 3))
    best, likelihood = estimate(a[some], b[some], n_a[some], n_b[some])
    at = log_likelihood(percent / 100, above[some], below[some], n_a[some], n_b[some])
    may[some] = (best >= percent / 100) | (likelihood - at <= AGAINST)
    return may


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sets without repeats."""
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def similar(sets: tuple[np.ndarray, np.ndarray], sketches: tuple[np.ndarray, np.ndarray], percent: int) -> bool:
    """Whether 100 * intersection >= percent * union; sketches that speak clearly against it decide alone."""
    return bool(similar_pairs([sets], sketches[0][None], sketches[1][None], percent)[0])


def similar_pairs(pairs: list[tuple[np.ndarray, np.ndarray]], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The same for many pairs of sets, and their sketches row by row."""
    n_a, n_b = (np.array([len(p[side]) for p in pairs], np.int64) for side in (0, 1))
    keep = _may_be_similar(a, b, n_a, n_b, percent)
    for k in np.flatnonzero(keep):
        common = _common(*pairs[k])
        keep[k] = 100 * common >= percent * (n_a[k] + n_b[k] - common)
    return keep


#: Shingles that two blocks of sets are counted over at a time.
COUNTED = 4096


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``: products of the sets as rows of 0 and 1."""
    counts = np.zeros((len(a), len(b)), np.int64)
    hashes = [np.concatenate(x) for x in (a, b)]
    shared = np.intersect1d(*hashes)
    sides = []
    for x, h in zip((a, b), hashes, strict=True):
        place = np.searchsorted(shared, h)
        there = np.flatnonzero(place < len(shared))
        there = there[shared[place[there]] == h[there]]
        there = there[np.argsort(place[there], kind="stable")]
        sides.append((np.repeat(np.arange(len(x)), [len(y) for y in x])[there], place[there]))
    for start in range(0, len(shared), COUNTED):
        parts = []
        for x, (owner, place) in zip((a, b), sides, strict=True):
            first, last = np.searchsorted(place, (start, start + COUNTED))
            part = np.zeros((len(x), min(COUNTED, len(shared) - start)), np.float32)
            part[owner[first:last], place[first:last] - start] = 1
            parts.append(part)
        counts += (parts[0] @ parts[1].T).astype(np.int64)
    return counts


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set."""
    lengths = np.array([len(s) for s in sets], np.int64)
    some = lengths > 0
    out = np.zeros((2, len(sets)), np.uint64)
    if some.any():
        values, starts = np.concatenate(sets), (np.cumsum(lengths) - lengths)[some]
        out[0, some] = np.add.reduceat(_mixed(values ^ np.uint64(_C)), starts)
        out[1, some] = np.add.reduceat(_mixed(values + np.uint64(_B)), starts)
    return out[0].astype(np.int64), out[1].astype(np.int64)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of (id, text) batches of bounded bytes."""
    for whole in batches:
        upto = np.cumsum(pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False))
        start = 0
        while start < whole.num_rows:
            before = upto[start - 1] if start else 0
            full = int(np.searchsorted(upto, before + BATCH_BYTES)) + 1
            stop = min(full, start + BATCH_TEXTS, whole.num_rows)
            batch = whole.slice(start, stop - start)
            yield batch, batch.column(1).to_pylist()
            start = stop


SKETCHED = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """Size, name and band keys of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _text_batches(batches):
            sets = shingle_sets(texts, words)
            lengths = np.array([len(s) for s in sets], np.int64)
            keys = bands(registers_of([s for s in sets if len(s)])).astype(np.int64)
            offsets = np.cumsum([0, *np.where(lengths > 0, REGISTERS // ROWS, 0)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            columns = [batch.column(0), pa.array(lengths), *map(pa.array, _digests(sets)), listed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "bands"])

    return docs.mapInArrow(run, SKETCHED)


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``id``, ``n``, the set and the registers, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _text_batches(batches):
            sets = shingle_sets(texts, words)
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            made = iter(registers_of([s for s in sets if len(s)]))
            sketches = pa.array([next(made).tobytes() if len(s) else b"" for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, sketches], ["id", "n", "hashes", "sketch"])

    return docs.mapInArrow(run, "id long, n long, hashes binary, sketch binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("hashes_a"), F.col("sketch").alias("sketch_a"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hashes_b"), F.col("sketch").alias("sketch_b"))
    met = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "hashes_a", "hashes_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets_of = [tuple(np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3)) for i in range(batch.num_rows)]
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            yield batch.select(["a", "b"]).filter(pa.array(similar_pairs(sets_of, x, y, percent)))

    return met.mapInArrow(run, "a long, b long")


def _labelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Bucket members with their component so far."""
    known = components(edges)
    return stored(members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")


def _sizes_fit(percent: int) -> Column:
    return F.lit(100) * F.least("n", "n2") >= F.lit(percent) * F.greatest("n", "n2")


def link_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents whose sets of ``words``-word shingles have 100 * intersection >= ``percent`` * union are
    linked. ``component_id`` is the least doc_id reachable, ``kept`` marks it. A missing text and one
    without words have no shingles and link with nothing, nor do rows without doc_id, whose component_id is
    missing and which are kept. Equal rows are in one component. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    sketched = stored(_sketched(texts, words), "sketches")
    linkable = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = linkable.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"))
    # A set's least document stands for it; its band keys come from its own row.
    named = linkable.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "k1", "k2", "bands")
    standing = stored(named.join(classes, ["k1", "k2", "id"], "left_semi").dropDuplicates(["id", "k1", "k2"]), "standing")
    banded = standing.select("id", "n", F.posexplode("bands").alias("band", "key"))
    # Each band row is shuffled once; most are alone in their bucket and end here.
    bucket = Window.partitionBy("key")
    held = banded.withColumns({"leader": F.min("id").over(bucket), "last": F.max("id").over(bucket)})
    members = stored(held.where("leader <> last").drop("last"), "buckets")

    chosen = stored(members.select("id").distinct(), "candidates")
    few = chosen.count() <= BROADCAST_IDS
    picked = texts.withColumnRenamed("doc_id", "id").join(F.broadcast(chosen) if few else chosen, "id", "left_semi")
    sets = stored(_full_sets(picked, words), "sets")

    first = members.where("id <> leader").groupBy("id").agg(F.min("leader").alias("a"))
    tested = stored(first.select("a", F.col("id").alias("b")), "pairs")
    edges = stored(_confirmed(tested, sets, percent), "links")

    def compared(pairs: DataFrame) -> tuple[int, int]:
        """Look at the pairs that are new; how many, and how many of them are links."""
        nonlocal edges, tested
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        looked_at = pairs.count()
        if not looked_at:
            return 0, 0
        found = stored(_confirmed(pairs, sets, percent), "links")
        edges, tested = edges.unionByName(found), tested.unionByName(pairs)
        return looked_at, found.count()

    for turn in count():
        looked_at, linked = compared(_pivot_pairs(_labelled(members, edges), percent, turn))
        if linked <= WORTHWHILE * looked_at:
            break
    open_ = _open_members(_labelled(members, edges), sets, standing, percent)
    edges = edges.unionByName(stored(_block_links(open_, sets, percent), "links"))
    compared(_cross_pairs(open_, percent))

    joint = components(edges)
    linked = classes.join(joint, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("component_id"))
    joined = sketched.join(linked, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.least("component_id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _pivot_pairs(labelled: DataFrame, percent: int, turn: int) -> DataFrame:
    """Members outside their bucket's main component with a pivot of it, another one in each bucket and turn.

    A member is in many buckets; ``PIVOTS`` pivots of theirs are drawn for it.
    """
    counted = labelled.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = counted.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
    open_ = labelled.join(main.where("parts > 1").select("key", "main"), "key")
    order = F.xxhash64("id", "key", F.lit(turn))
    pivots = open_.where("component = main").groupBy("key").agg(F.min_by(F.struct("id", "n"), order).alias("pivot"))
    met = open_.where("component <> main").join(pivots, "key").select("id", "n", F.col("pivot.id").alias("id2"), F.col("pivot.n").alias("n2"))
    met = met.where(_sizes_fit(percent)).select("id", F.struct(F.xxhash64("id2", F.lit(turn)).alias("order"), "id2").alias("p"))
    drawn = met.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("p")), 1, PIVOTS).alias("drawn"))
    return _as_pairs(drawn.select("id", F.explode("drawn").alias("p")).select("id", "p.id2"))


def _common_sizes(sets: DataFrame, percent: int) -> DataFrame:
    """``id`` and ``common``: how many shingles a set has in common with any of the others.

    The intersection with another set can't be larger; sets that lie below the threshold for it
    even against their own common part are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(start, BATCH_TEXTS)
                hashes = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
                ids = np.repeat(batch.column(0).to_numpy(), [len(h) for h in hashes])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(ids)], ["hash", "id"])

    each = sets.select("id", "hashes").mapInArrow(run, "hash long, id long")
    own = each.groupBy("hash").agg(F.count("*").alias("holders"), F.min("id").alias("id")).where("holders = 1")
    own = own.groupBy("id").agg(F.count("*").alias("own"))
    sizes = sets.groupBy("id").agg(F.max("n").alias("n")).join(own, "id", "left")
    return sizes.select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")).where(
        F.lit(100) * F.col("common") >= F.lit(percent) * F.col("n")
    )


def _open_members(labelled: DataFrame, sets: DataFrame, standing: DataFrame, percent: int) -> DataFrame:
    """Members of buckets with several components, with common parts large enough for a link, and the
    ``size`` of their component among these."""
    least = labelled.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("two")).where("one <> two")
    open_ = labelled.join(least.select("key"), "key", "left_semi")
    concerned = sets.join(open_.select("id").distinct(), "id", "left_semi")
    common = stored(_common_sizes(concerned, percent), "common").select("id", "common")
    open_ = open_.join(common, "id").join(standing.select("id", "bands"), "id")
    sizes = open_.select("id", "component").distinct().groupBy("component").agg(F.count("*").alias("size"))
    return stored(open_.join(sizes, "component"), "open")


def _block_links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of outsiders with large components that they share a bucket with.

    The component's members lie in blocks; an outsider is compared with a block as a whole and brings
    back one link at most, so no pairs are listed. Both sides of a group are of bounded size.
    """
    large = open_.where(F.col("size") > BLOCK)
    there = large.select("key", F.col("component").alias("large"), F.col("size").alias("large_size")).distinct()
    smaller = F.struct("size", "component") < F.struct(F.col("large_size").alias("size"), F.col("large").alias("component"))
    meets = open_.join(there, "key").where(smaller).select("id", "common", "large", "large_size").distinct()
    blocks = F.ceil(F.col("large_size") / BLOCK).cast("int")
    outsiders = meets.groupBy("large").agg(F.count("*").alias("outsiders"))
    slices = F.ceil(F.col("outsiders") / BLOCK).cast("int")
    left = meets.join(outsiders, "large").withColumn("slice", F.pmod(F.xxhash64("id"), slices).cast("int"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    left = left.select("large", "block", "slice", "id", "common").join(sets.select("id", "hashes"), "id")
    members = large.select("id", "common", F.col("component").alias("large"), F.col("size").alias("large_size")).distinct()
    right = members.join(outsiders, "large").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    right = right.select("large", "block", "slice", "id", "common").join(sets.select("id", "hashes"), "id")
    right = right.select(*[F.col(c).alias(f"{c}2") for c in ("large", "block", "slice", "id", "common", "hashes")])

    def taken(table: pa.Table, tag: str) -> list[tuple]:
        columns = (table.column(f"{c}{tag}").to_pylist() for c in ("id", "common", "hashes"))
        return [(i, c, np.frombuffer(h, np.uint64)) for i, c, h in zip(*columns, strict=True)]

    def compare(outside: pa.Table, inside: pa.Table) -> pa.Table:
        a, b = taken(outside, ""), taken(inside, "2")
        n, m = (np.array([len(h) for _, _, h in x], np.int64) for x in (a, b))
        both = common_counts([h for _, _, h in a], [h for _, _, h in b]) if a and b else np.zeros((len(a), len(b)), np.int64)
        linked = 100 * both >= percent * (n[:, None] + m - both)
        links = [(a[i][0], b[int(linked[i].argmax())][0]) for i in np.flatnonzero(linked.any(1))]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    groups = left.groupBy("large", "block", "slice").cogroup(right.groupBy("large2", "block2", "slice2"))
    return groups.applyInArrow(compare, "a long, b long")


def _cross_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket between different components that are not large.

    A pair that shares several buckets comes from the first of them.
    """
    small = open_.where(F.col("size") <= BLOCK)
    other = small.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "component", "common", "bands")])
    most = F.least("common", "common2")
    likely = F.lit(100) * most >= F.lit(percent) * (F.col("n") + F.col("n2") - most)
    same = F.zip_with("bands", "bands2", lambda x, y: x == y)
    first = F.array_position(same, True) == F.col("band") + 1
    new = (F.col("id") < F.col("id2")) & (F.col("component") != F.col("component2")) & likely & first
    return _as_pairs(small.join(other, "key").where(new))


def _as_pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).where("a <> b").distinct()


def _vertices(rows: DataFrame) -> DataFrame:
    """``rows`` (whole, doc_id, text) with ``vertex``: what names a text among all.

    It is the doc_id. Where one doc_id comes with several texts, only the one of the least hash keeps it;
    the others get numbers from 2^62 on, drawn from their text, so that none is taken for another.
    """
    rows = rows.withColumn("hash", F.xxhash64("text"))
    firsts = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("hash").alias("first"), F.max("hash").alias("last"))
    repeated = stored(firsts.where("first <> last").select("doc_id", "first"), "repeated-ids")
    other = F.lit(1 << 62) + F.col("hash").bitwiseAND(F.lit((1 << 61) - 1))
    vertex = F.when(F.col("first").isNull() | (F.col("hash") == F.col("first")), F.col("doc_id")).otherwise(other)
    return rows.join(repeated, "doc_id", "left").withColumn("vertex", vertex)


def stage(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one of the least doc_id, with all columns; repeated rows of it once.

    A doc_id that comes with several texts names several documents, each kept or dropped for its own
    text. Rows without doc_id stay.
    """
    texts = carried(docs).select("whole", F.col("whole.doc_id").cast("long").alias("doc_id"), whole_text("whole.text").alias("text"))
    rows = _vertices(texts)
    kept = link_documents(rows.select(F.col("vertex").alias("doc_id"), "text"), words, percent)
    kept = kept.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("vertex")).distinct()
    nth = F.row_number().over(Window.partitionBy("vertex").orderBy("hash"))
    rows = rows.select("whole", "vertex", "hash")
    first = rows.where("vertex IS NOT NULL").join(kept, "vertex", "left_semi").withColumn("nth", nth).where("nth = 1")
    return first.unionByName(rows.where("vertex IS NULL").withColumn("nth", F.lit(1))).select("whole.*")
