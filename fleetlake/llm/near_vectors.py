"""Embedding near-dedup by an epsilon grid order join.

Unit vectors of cosine c or more lie within epsilon = sqrt(2 - 2c) of each other. Turned to the principal
directions of all vectors, they are sorted by grid cells of width epsilon on the leading directions.
The sorted sequence is cut into intervals, each with its bounding box. Pairs of intervals meet where
their cells are neighbours and their boxes within epsilon, and are joined recursively: both are halved
at a plane, and across it only those are kept whose squared distances to all planes crossed so far can still add up to
epsilon squared. Small parts are compared by matrix products over the leading directions and the length
of the rest, which is never below the cosine; what passes is decided in double precision.

An interval is shipped to another one through no shuffle: unless few pairs meet, tasks read both from the shared folder.

Equal vectors are one vector with a weight, and two intervals that are provably within epsilon as a
whole are linked by their weights alone. Each pair of intervals returns counts and a spanning set of
links per vector, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components

#: Vectors of an interval at least (of large tables: as many as make ``INTERVALS``, but not more bytes
#: than ``INTERVAL_BYTES``), and a quarter of the vectors of a part that is compared without further halving.
INTERVAL, LEAF = 2048, 384
INTERVALS, INTERVAL_BYTES = 32, 16 << 20
#: Leading directions that order the vectors, and that are halved and multiplied in single precision.
LEADING, COMPARED = 12, 24
LINKS = "id long, links long, label long"
#: Rounding of products and boxes; what is within it is decided by plain products. The same in single precision.
SLACK, SINGLE_SLACK = 1e-9, 2e-5
#: Links that are kept until they are united, and pairs of intervals for each interval that are shipped by a join.
PENDING, SHIPPED = 1 << 20, 0.5


def _vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comparable vectors with a 128-bit key of their components, and the vec_ids of all others."""
    values = F.col("embedding").cast("array<double>")
    least, largest = F.array_min(values), F.array_max(values)  # NaN is the largest of all
    finite = F.forall(values, lambda v: v.isNotNull()) & (least > float("-inf")) & (largest < float("inf"))
    good = F.coalesce(finite & ((least != 0) | (largest != 0)), F.lit(False))
    # Single precision is kept as it is: half the bytes, and its doubles are exact.
    plain = F.col("embedding") if dict(rows.dtypes)["embedding"] == "array<float>" else values
    marked = rows.select("vec_id", plain.alias("v"), values.alias("values"), good.alias("good"))
    keys = [F.xxhash64(F.lit(i), "values").alias(f"k{i}") for i in (1, 2)]
    return marked.where("good").select("vec_id", "v", *keys), marked.where("NOT good").select("vec_id")


def _arrays(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    """A column of lists as rows of ``width`` in its own precision; missing trailing components are 0."""
    lists = batch.column(column)
    lengths = np.diff(lists.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    out = np.zeros((batch.num_rows, width), lists.type.value_type.to_pandas_dtype())
    for i, row in enumerate(lists.to_pylist()):
        out[i, : len(row)] = row
    return out


def _units(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components leave the range of doubles.
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_directions(classes: DataFrame, width: int) -> np.ndarray:
    """Orthogonal directions of falling variance over all vectors; sums of ``width`` squared numbers meet."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, mean = np.zeros((width, width)), 0, np.zeros(width)
        for batch in batches:
            u = _units(_arrays(batch, 0, width))
            total, count, mean = total + u.T @ u, count + len(u), mean + u.sum(0)
        if count:
            rows = np.concatenate([total, mean[None], np.full((1, width), count)])
            yield pa.RecordBatch.from_arrays([pa.array(range(width + 2), pa.int32()), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    sums = classes.select("v").mapInArrow(partial, "i int, row array<double>")
    sums = sums.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    table = np.zeros((width + 2, width))
    for i, j, x in sums:
        table[i, j] = x
    count = max(1.0, table[-1, 0])
    mean = table[-2] / count
    values, directions = np.linalg.eigh(table[:width] / count - np.outer(mean, mean))
    return directions[:, np.argsort(-values)]


def _intervals(rows: DataFrame, width: int, directions: np.ndarray, epsilon: float) -> DataFrame:
    """The sorted sequence in intervals: ``block`` (its least id), packed rows, and the bounding box."""
    leading = min(LEADING, width)
    kind = rows.schema["v"].dataType.simpleString()
    value_bytes = 4 if kind == "array<float>" else 8
    count = rows.count()
    size = min(max(INTERVAL, -(-count // INTERVALS)), max(LEAF, INTERVAL_BYTES // (width * value_bytes)))
    most = size + size // 4  # ranges are cut by a sample

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = np.floor(_units(_arrays(batch, 2, width)) @ directions[:, :leading] / epsilon)
            # Big-endian from 0 on: bytes are ordered as the cells are.
            cells = (np.clip(grid, -(2.0**31), 2.0**31 - 1).astype(np.int64) + (1 << 31)).astype(">u4")
            columns = [*(batch.column(i) for i in range(3)), pa.array([row.tobytes() for row in cells], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "v", "cell"])

    placed = rows.select("id", "n", "v").mapInArrow(turned, f"id long, n long, v {kind}, cell binary")
    order = ["cell", "id"]
    sequence = placed.repartitionByRange(max(1, -(-count // size)), *order).sortWithinPartitions(*order).select("id", "n", "v")

    def interval(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, n, v = (np.concatenate(p) for p in zip(*parts, strict=True))
        low, high = np.full(width, np.inf), np.full(width, -np.inf)
        for start in range(0, len(v), INTERVAL):
            y = _units(v[start : start + INTERVAL]) @ directions
            low, high = np.minimum(low, y.min(0)), np.maximum(high, y.max(0))
        values = [[int(ids.min())], [int(n.sum())], [ids.tobytes()], [n.tobytes()], [v.tobytes()], [(low - SLACK).tolist()], [(high + SLACK).tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["block", "weight", "ids", "n", "v", "low", "high"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for whole in batches:
            start = 0
            while start < whole.num_rows:
                batch = whole.slice(start, most - held)
                ids, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                parts.append((ids, n, _arrays(batch, 2, width)))
                start, held = start + len(ids), held + len(ids)
                if held == most:
                    yield interval(parts)
                    parts, held = [], 0
        if parts:
            yield interval(parts)

    return sequence.mapInArrow(cut, "block long, weight long, ids binary, n binary, v binary, low array<double>, high array<double>")


def _box_distance(nearest: bool) -> Column:
    """Least or largest squared distance between two bounding boxes (low, high) and (low2, high2)."""
    up = F.zip_with("low2", "high", lambda a, b: a - b)
    down = F.zip_with("low", "high2", lambda a, b: a - b)
    if nearest:
        gaps = F.zip_with(up, down, lambda a, b: F.greatest(a, b, F.lit(0.0)))
    else:
        gaps = F.zip_with(up, down, lambda a, b: F.greatest(-a, -b))
    return F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g)


def _interval_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs ``a`` <= ``b`` of intervals that may hold links; ``all`` if every pair of their vectors is one."""
    boxes = blocks.select("block", "low", "high", "weight")
    cell = F.floor(F.col("low")[0] / epsilon), F.floor(F.col("high")[0] / epsilon)
    mine = boxes.select(F.col("block").alias("a"), "low", "high", F.explode(F.sequence(*cell)).alias("cell"))
    near = boxes.select(
        F.col("block").alias("b"), F.col("low").alias("low2"), F.col("high").alias("high2"), F.explode(F.sequence(cell[0] - 1, cell[1] + 1)).alias("cell")
    )
    met = mine.join(near, "cell").where("a <= b").drop("cell").dropDuplicates(["a", "b"])
    return met.where(_close(epsilon)).select("a", "b", _whole(epsilon).alias("all"))


def _close(epsilon: float) -> Column:
    return _box_distance(True) <= epsilon * epsilon * (1 + SLACK) + SLACK


def _whole(epsilon: float) -> Column:
    return _box_distance(False) <= epsilon * epsilon * (1 - 1e-6)


class _Side:
    """An interval: ids, weights, vectors, and the leading coordinates with the length of the rest (a unit vector too)."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, v: np.ndarray, directions: np.ndarray):
        self.ids, self.n, self.v = ids, n, v
        leading = min(COMPARED, directions.shape[1])
        self.w = np.empty((len(ids), leading + 1), np.float32)
        for start in range(0, len(ids), 4096):
            y = _units(v[start : start + 4096]) @ directions
            part = self.w[start : start + 4096]
            part[:, :leading] = y[:, :leading]
            part[:, leading] = np.sqrt(np.einsum("ij,ij->i", y[:, leading:], y[:, leading:]))

    def units(self, rows: np.ndarray) -> np.ndarray:
        return _units(self.v[rows])


class _Joined:
    """Links between two intervals (or within one, if the other is None)."""

    def __init__(self, a: _Side, b: _Side | None, cosine: float):
        self.cosine, self.epsilon2 = cosine, max(0.0, 2 - 2 * cosine) + SINGLE_SLACK
        self.same = b is None
        self.a, self.b = a, a if b is None else b
        # Places of b follow those of a.
        self.shift = 0 if self.same else len(a.ids)
        ids = a.ids if self.same else np.concatenate([a.ids, b.ids])
        self.links = np.zeros(len(ids), np.int64)
        self.root = np.arange(len(ids))
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.out = np.empty(4 * LEAF * LEAF, np.float32)
        everything = [np.arange(len(x.ids)) for x in (self.a, self.b)]
        used = np.zeros(a.w.shape[1], bool)
        if self.same:
            self.join_within(everything[0], used)
        else:
            self.join(*everything, *(np.zeros(len(i), np.float32) for i in everything), used)
        self.unite()
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, self.root, ids)
        self.ids, self.label = ids, least[self.root]

    def plane(self, i: np.ndarray, j: np.ndarray, used: np.ndarray) -> tuple[int, float] | None:
        """The unused direction of the widest spread, above all between both, and where to halve; None if that parts nothing."""
        x, y = self.a.w[i[:: max(1, len(i) // 64)]], self.b.w[j[:: max(1, len(j) // 64)]]
        means = x.mean(0), y.mean(0)
        spread = np.where(used, -1.0, x.var(0) + y.var(0) + 2 * (means[0] - means[1]) ** 2)
        d = int(spread.argmax())
        return (d, float(means[0][d] + means[1][d]) / 2) if spread[d] * 8 > self.epsilon2 else None

    def join(self, i: np.ndarray, j: np.ndarray, cost_i: np.ndarray, cost_j: np.ndarray, used: np.ndarray) -> None:
        """Places ``i`` of a and ``j`` of b; the costs are squared distances to the planes that part them."""
        if not (len(i) and len(j)):
            return
        found = self.plane(i, j, used) if len(i) * len(j) > 16 * LEAF * LEAF else None
        if found is None:
            return self.compare(i, j, cost_i, cost_j)
        d, t = found
        x, y = self.a.w[i, d] - np.float32(t), self.b.w[j, d] - np.float32(t)
        up, high, then = x >= 0, y >= 0, used.copy()
        then[d] = True
        self.join(i[up], j[high], cost_i[up], cost_j[high], then)
        self.join(i[~up], j[~high], cost_i[~up], cost_j[~high], then)
        self.across(i[up], j[~high], cost_i[up] + x[up] ** 2, cost_j[~high] + y[~high] ** 2, then)
        self.across(i[~up], j[high], cost_i[~up] + x[~up] ** 2, cost_j[high] + y[high] ** 2, then)

    def across(self, i: np.ndarray, j: np.ndarray, cost_i: np.ndarray, cost_j: np.ndarray, used: np.ndarray) -> None:
        if len(i) and len(j):
            near = cost_j <= self.epsilon2 - cost_i.min()
            j, cost_j = j[near], cost_j[near]
        if len(i) and len(j):
            near = cost_i <= self.epsilon2 - cost_j.min()
            self.join(i[near], j, cost_i[near], cost_j, used)

    def join_within(self, i: np.ndarray, used: np.ndarray) -> None:
        found = self.plane(i, i, used) if len(i) > 4 * LEAF else None
        if found is None:
            return self.compare_within(i)
        d, t = found
        x, then = self.a.w[i, d] - np.float32(t), used.copy()
        up = x >= 0
        then[d] = True
        self.join_within(i[up], then)
        self.join_within(i[~up], then)
        self.across(i[up], i[~up], x[up] ** 2, x[~up] ** 2, then)

    def compare(self, i: np.ndarray, j: np.ndarray, cost_i: np.ndarray, cost_j: np.ndarray) -> None:
        """The pairs whose costs leave a chance, in order of these."""
        order_i, order_j = cost_i.argsort(), cost_j.argsort()
        i, j, cost_i, cost_j = i[order_i], j[order_j], cost_i[order_i], cost_j[order_j]
        wa, wb = self.a.w[i], self.b.w[j]
        for p in range(0, len(i), LEAF):
            stop = int(np.searchsorted(cost_j, self.epsilon2 - cost_i[p], "right"))
            for q in range(0, stop, 4 * LEAF):
                till = min(stop, q + 4 * LEAF)
                self.tile(i[p : p + LEAF], j[q:till], wa[p : p + LEAF], wb[q:till])

    def compare_within(self, i: np.ndarray) -> None:
        w = self.a.w[i]
        for p in range(0, len(i), 2 * LEAF):
            for q in range(p, len(i), 2 * LEAF):
                self.tile(i[p : p + 2 * LEAF], i[q : q + 2 * LEAF], w[p : p + 2 * LEAF], w[q : q + 2 * LEAF], p == q)

    def tile(self, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray, itself: bool = False) -> None:
        bound = np.dot(left, right.T, out=self.out[: len(i) * len(j)].reshape(len(i), len(j)))
        if bound.max() >= self.cosine - SINGLE_SLACK:
            self.decide(i, j, bound, itself)

    def decide(self, i: np.ndarray, j: np.ndarray, bound: np.ndarray, itself: bool) -> None:
        """Links among the pairs of a tile whose bounds allow them."""
        hits = np.flatnonzero(bound >= self.cosine - SINGLE_SLACK)
        if 16 * len(hits) > bound.size:
            ua, ub = self.a.units(i), self.b.units(j)
            cosines = ua @ ub.T
            for p, q in np.argwhere(np.abs(cosines - self.cosine) < SLACK):
                cosines[p, q] = _exact_cosine(ua[p], ub[q])
            links = cosines >= self.cosine
            if itself:
                np.fill_diagonal(links, False)
            self.links[i] += (links @ self.b.n[j].astype(np.float64)).astype(np.int64)
            if not itself:
                self.links[self.shift + j] += (self.a.n[i].astype(np.float64) @ links).astype(np.int64)
            roots = self.root[i], self.root[self.shift + j]
            if (roots[0] == roots[0][0]).all() and (roots[1] == roots[0][0]).all():
                return
            p, q = np.nonzero(links)
        else:
            p, q = np.divmod(hits, len(j))
            if itself:
                p, q = p[p < q], q[p < q]
            ua, ub = self.a.units(i[p]), self.b.units(j[q])
            cosines = np.einsum("ij,ij->i", ua, ub)
            for k in np.flatnonzero(np.abs(cosines - self.cosine) < SLACK):
                cosines[k] = _exact_cosine(ua[k], ub[k])
            p, q = p[cosines >= self.cosine], q[cosines >= self.cosine]
            np.add.at(self.links, i[p], self.b.n[j[q]])
            np.add.at(self.links, self.shift + j[q], self.a.n[i[p]])
        p, q = i[p], self.shift + j[q]
        new = self.root[p] != self.root[q]
        if new.any():
            self.pending.append((p[new], q[new]))
            if sum(len(p) for p, _ in self.pending) > PENDING:
                self.unite()

    def unite(self) -> None:
        """Roots of linked places become the least of them."""
        if not self.pending:
            return
        p, q = (self.root[np.concatenate(x)] for x in zip(*self.pending, strict=True))
        self.pending, label = [], np.arange(len(self.root))
        while True:
            least = np.minimum(label[p], label[q])
            new = label.copy()
            np.minimum.at(new, p, least)
            np.minimum.at(new, q, least)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        self.root = label[self.root]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = self.links > 0
        return self.ids[some], self.links[some], self.label[some]


def _exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(x * y for x, y in zip(a.tolist(), b.tolist(), strict=True))


def link_vectors(rows: DataFrame, cosine: float = 0.95) -> DataFrame:
    """A row for each vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors are linked if their cosine, in double precision, is ``cosine`` or more. ``n_links`` counts
    the other rows linked directly, ``component_id`` is the least vec_id reachable, ``kept`` marks it. Vectors
    that are missing, zero, or hold missing or non-finite components have no links. A shorter vector counts
    as filled up with zeros. Rows of equal vec_id are one vector if equal, else two of one name. An empty
    table gives an empty result.
    """
    epsilon = float(np.sqrt(2 - 2 * cosine))
    spark = rows.sparkSession
    good, others = _vectors(rows)
    classes = stored(
        good.groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v")).withColumn("id", F.xxhash64("k1", "k2")),
        "vectors",
    )
    width = classes.agg(F.max(F.size("v"))).collect()[0][0]
    if width:
        directions = principal_directions(classes, width)
        blocks = stored(_intervals(classes, width, directions, epsilon), "intervals")
        pairs = stored(_interval_pairs(blocks, epsilon), "interval-pairs")
        numbers = np.float32 if dict(classes.dtypes)["v"] == "array<float>" else np.float64

        def opened(ids: pa.Scalar, n: pa.Scalar, v: pa.Scalar) -> _Side:
            values = np.frombuffer(v.as_buffer(), numbers).reshape(-1, width)
            return _Side(np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int64), values, directions)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last = left = None
            for batch in batches:
                for i in range(batch.num_rows):
                    block, *blobs = (c[i] for c in batch.columns)
                    if block.as_py() != last:  # a block meets one after the other
                        last, left = block.as_py(), opened(*blobs[:3])
                    right = opened(*blobs[3:]) if blobs[3:] else None
                    columns = _Joined(left, right, cosine).rows()
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "links", "label"])

        packed = ["block", "ids", "n", "v"]
        second = blocks.select(*[F.col(c).alias(f"{c}2") for c in packed], F.col("low").alias("low2"), F.col("high").alias("high2"))
        first = blocks.select(*[F.col(c).alias(f"{c}1") for c in packed], "low", "high")
        itself = blocks.withColumns({"low2": F.col("low"), "high2": F.col("high")}).where(~_whole(epsilon))
        compared = itself.select(packed).mapInArrow(run, LINKS)
        apart = pairs.where("a < b AND NOT all")
        meeting = apart.count()
        if meeting > SHIPPED * blocks.count():
            # Tasks of two partitions each, which read them. By the last bit, either task of two gets some of the pairs.
            in_turn = F.col("block1").bitwiseXOR(F.col("block2")).bitwiseAND(1) == (F.col("block1") < F.col("block2")).cast("long")
            wanted = in_turn & (F.col("block1") != F.col("block2")) & _close(epsilon) & ~_whole(epsilon)
            met = first.hint("shuffle_replicate_nl").join(second, wanted)
        else:  # few pairs: they are broadcast, and each ships two intervals
            met = first.join(F.broadcast(apart), F.col("a") == F.col("block1"))
            met = met.join(second.join(F.broadcast(apart.select("b").distinct()), F.col("b") == F.col("block2"), "left_semi"), F.col("b") == F.col("block2"))
        if meeting:
            compared = compared.unionByName(met.select("block1", "ids1", "n1", "v1", "ids2", "n2", "v2").mapInArrow(run, LINKS))

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, ids, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids, n = np.frombuffer(ids, np.int64), np.frombuffer(n, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(ids), pa.array(n)], ["block", "id", "n"])

        # Intervals linked as a whole: each vector gets the other interval's weight, and both hang together.
        wholly = pairs.where("all").join(blocks.select(F.col("block").alias("a"), F.col("weight").alias("weight_a")), "a")
        wholly = wholly.join(blocks.select(F.col("block").alias("b"), F.col("weight").alias("weight_b")), "b")
        sides = F.array(F.struct(F.col("a").alias("block"), F.col("weight_b").alias("w")), F.struct(F.col("b").alias("block"), F.col("weight_a").alias("w")))
        gains = wholly.select("a", "b", F.explode(sides).alias("s")).select("a", "b", "s.*").distinct()
        gains = gains.groupBy("block").agg(F.sum("w").alias("w"), F.max((F.col("a") == F.col("b")).cast("int")).alias("own"), F.min("a").alias("label"))
        rows_of = blocks.select("block", "ids", "n").mapInArrow(members, "block long, id long, n long")
        whole = rows_of.join(gains, "block").select("id", (F.col("w") - F.col("own") * F.col("n")).alias("links"), "label")
        found = stored(compared.unionByName(whole), "links")
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        hubs = wholly.select("a", "b")
        joint = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(hubs))
    else:
        links = spark.createDataFrame([], "id long, links long")
        joint = spark.createDataFrame([], "id long, component long")
    named = classes.select("id", "k1", "k2", "n", "least").join(joint, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(links, "id", "left")
    result = named.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    named = good.select("vec_id", "k1", "k2").join(stored(result, "linked"), ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    every = named.unionByName(others.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return every.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", kept.alias("kept"))
