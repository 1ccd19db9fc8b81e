"""Nearest vectors by stable projections: few projected dimensions, a kd-tree over them, and a chi-square test that ends the search."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.vectors import dimension, directions, stacked, usable
from chatmill.operators.staging import stage

# Projected dimensions; the chance with which a true neighbour must have been reached when a search ends.
PROJECTED, CERTAINTY = 8, 0.995
# Vectors of an index cell (one task's tree), of a leaf, and queries of a task.
CELL, LEAF, QUERIES = 8192, 256, 512
# Vectors that the cuts between cells are fitted on, at most. Every vector is indexed.
SAMPLE = 65_536


def chi_square_limit(certainty: float, freedom: int) -> float:
    """The value that a chi-square variable stays below with this chance."""

    def below(x: float) -> float:  # regularised lower gamma function of freedom / 2, x / 2, as a series
        a, z = freedom / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= z / n
            total += term
        return total * math.exp(-z + a * math.log(z) - math.lgamma(a))

    low, high = 1e-9, freedom + 20 * math.sqrt(2 * freedom) + 40
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certainty else (low, middle)
    return high


def projection(size: int, seed: int = 42) -> np.ndarray:
    """Normal numbers: a difference of length d is projected to d squared times a chi-square variable of PROJECTED degrees."""
    return np.random.default_rng(seed).standard_normal((size, PROJECTED))


class Cuts:
    """Cells of about equal numbers of sampled points: cut at the median of the widest dimension, again and again."""

    def __init__(self, points: np.ndarray, cells: int):
        self.dims: list[int] = []
        self.at: list[float] = []
        self.sides: list[tuple[int, int]] = []  # a node, or -1 - cell
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        everywhere = np.full(PROJECTED, np.inf)
        self.root = self._cut(points, cells, -everywhere, everywhere)

    def _cut(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(PROJECTED)
        dim = int(spread.argmax())
        if cells <= 1 or len(points) < 2 or spread[dim] == 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        left_cells = cells // 2
        at = float(np.quantile(points[:, dim], left_cells / cells))
        node = len(self.dims)
        self.dims.append(dim)
        self.at.append(at)
        self.sides.append((0, 0))
        below = points[:, dim] < at
        left_high, right_low = high.copy(), low.copy()
        left_high[dim] = right_low[dim] = at
        self.sides[node] = self._cut(points[below], left_cells, low, left_high), self._cut(points[~below], cells - left_cells, right_low, high)
        return node

    def cells_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                below = points[rows, self.dims[node]] < self.at[node]
                stack += [(self.sides[node][0], rows[below]), (self.sides[node][1], rows[~below])]
        return out

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared projected distance of each point from each cell."""
        low, high = np.array(self.low), np.array(self.high)
        out = np.empty((len(points), len(low)))
        for i, p in enumerate(points):
            gap = np.maximum(0, np.maximum(low - p, p - high))
            out[i] = (gap * gap).sum(axis=1)
        return out


class Tree:
    """A kd-tree of projected points, kept as its leaves with their boxes; they are read in the order of their distance from a query."""

    def __init__(self, points: np.ndarray):
        self.order, self.points = np.arange(len(points)), points
        self.spans: list[tuple[int, int]] = []
        stack = [(0, len(points))]
        while stack:
            low, high = stack.pop()
            own = points[self.order[low:high]]
            spread = own.max(axis=0) - own.min(axis=0)
            dim = int(spread.argmax())
            if high - low > LEAF and spread[dim] > 0:
                middle = (low + high) // 2
                self.order[low:high] = self.order[low:high][np.argpartition(own[:, dim], middle - low)]
                stack += [(low, middle), (middle, high)]
            else:
                self.spans.append((low, high))
        self.low = np.array([points[self.order[a:b]].min(axis=0) for a, b in self.spans])
        self.high = np.array([points[self.order[a:b]].max(axis=0) for a, b in self.spans])

    def leaves(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared distance of the leaf's box, its points), nearest first."""
        gap = np.maximum(0, np.maximum(self.low - query, query - self.high))
        gaps = (gap * gap).sum(axis=1)
        for leaf in np.argsort(gaps, kind="stable"):
            low, high = self.spans[leaf]
            yield float(gaps[leaf]), self.order[low:high]


def search(tree: Tree, units: np.ndarray, near: np.ndarray, query: np.ndarray, k: int, limit: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and squared distances of the points verified as possible members of the k nearest, k of them or fewer.

    Leaves come by projected distance. The search ends when the next lies so far that a point as near as the k-th best would have
    been projected nearer than that with the given certainty: projected distance squared over distance squared beyond `limit`.
    `bound` is a squared distance within which k are known from elsewhere.
    """
    places, found = np.zeros(0, np.int64), np.zeros(0)
    for gap, rows in tree.leaves(near):
        if gap > limit * bound:
            break
        d = tree.points[rows] - near
        rows = rows[(d * d).sum(axis=1) <= limit * bound]
        if len(rows):
            places = np.concatenate([places, rows])
            found = np.concatenate([found, np.maximum(0, 2 - 2 * (units[rows] @ query))])
            if len(found) > k:
                keep = found <= np.partition(found, k - 1)[k - 1] + 1e-9  # with ties
                places, found = places[keep], found[keep]
            if len(found) >= k:
                bound = min(bound, float(np.partition(found, k - 1)[k - 1]) + 1e-9)
    return places, found


def nearest(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, seed: int = 42) -> DataFrame:
    """(query_id, rank, key, score): for each row whose key is divisible by `every` its k nearest other rows by cosine.

    Ranks count from 1, nearest first, ties by the smaller key; score is the cosine of the vectors as given, in double
    precision. Queries with fewer than k other rows get them all. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null key, take no part. Rows of equal key are vectors of their own, but a query
    never finds a row of its own key. Vectors of unequal lengths are an error.

    Equal vectors are one point, which stands for the first k + 1 keys of its copies. All points are projected to PROJECTED
    dimensions and dealt to cells, whose cuts are fitted on at most SAMPLE points. A query searches its own cell first, which
    bounds its k-th distance, then every other cell that the chi-square test does not rule out; each cell has a kd-tree.
    The result is found again with any partitioning, since the test depends on distances only.
    """
    spark = ship(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    plain = rows.filter(F.col("key").isNotNull() & usable(F.col("vector"))).select("key", F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    schema = "query_id long, rank int, key long, score double"
    size = dimension(plain, "vector")
    if size is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    # The first keys of each vector: a window limit, so tasks drop what can't be among them before the shuffle.
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("key"))
    firsts = plain.withColumn("copy", copy).filter(F.col("copy") <= k + 1)
    points = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    index = stage(_with_projection(points, size, seed), "points")
    count = index.count()
    share = min(1.0, 1.2 * SAMPLE / count)
    sample = index.select("near").sample(False, share, seed).limit(SAMPLE) if share < 1 else index.select("near").limit(SAMPLE)
    cuts = spark.sparkContext.broadcast(Cuts(np.array([r["near"] for r in sample.toLocalIterator()]).reshape(-1, PROJECTED), max(1, round(count / CELL))))

    @F.arrow_udf(T.LongType())
    def cell_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(cuts.value.cells_of(stacked(column)) if len(column) else [], pa.int64())

    index = stage(index.withColumn("cell", cell_of("near")), "cells")
    asked = plain.filter(F.pmod("key", F.lit(every)) == 0)
    # A key may come with several vectors: queries are told apart by a number of their own.
    queries = stage(_with_projection(asked, size, seed).withColumn("cell", cell_of("near")).withColumn("query", F.monotonically_increasing_id()), "queries")
    limit = chi_square_limit(CERTAINTY, PROJECTED)

    first = _searched(index, queries.withColumn("bound", F.lit(float("inf"))), k, limit)
    first = stage(first, "found")
    kth = _best(first, k).groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.max("far")).alias("bound"))
    bounded = queries.join(kth, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def others(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for near, bound, own in batches:
            if not len(near):
                yield pa.array([], pa.list_(pa.int64()))
                continue
            gaps = cuts.value.distances(stacked(near))
            reach = gaps <= limit * bound.to_numpy()[:, None]
            yield pa.array([[c for c in np.flatnonzero(r) if c != o] for r, o in zip(reach, own.to_pylist(), strict=True)], pa.list_(pa.int64()))

    again = bounded.withColumn("cells", others("near", "bound", "cell")).drop("cell").withColumn("cell", F.explode("cells")).drop("cells")
    found = first.unionByName(_searched(index, again, k, limit))
    return _best(found, k).select(F.col("query_id"), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), F.col("score"))


def _with_projection(df: DataFrame, size: int, seed: int) -> DataFrame:
    kind = T.StructType([T.StructField("unit", T.ArrayType(T.DoubleType())), T.StructField("near", T.ArrayType(T.DoubleType()))])
    made = pa.struct([("unit", pa.list_(pa.float64())), ("near", pa.list_(pa.float64()))])

    @F.arrow_udf(kind)
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        turn = projection(size, seed)
        for column in batches:
            if not len(column):
                yield pa.array([], made)
                continue
            units = directions(stacked(column))
            yield pa.StructArray.from_arrays([pa.array(list(units), pa.list_(pa.float64())), pa.array(list(units @ turn), pa.list_(pa.float64()))], ["unit", "near"])

    return df.withColumn("p", project("vector")).select("*", "p.unit", "p.near").drop("p")


def _searched(index: DataFrame, queries: DataFrame, k: int, limit: float) -> DataFrame:
    """(query, query_id, key, far, score): the best of each query's cell. Queries of a cell come in parts, each with a copy of the cell."""
    parts = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("long").alias("parts"))
    asked = queries.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")))
    asked = asked.select("cell", "part", F.col("query"), F.col("key").alias("query_id"), "vector", "unit", "near", "bound")
    held = index.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    held = held.select("cell", "part", "keys", "vector", "unit", "near")

    def one(points: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if points.num_rows and wanted.num_rows:
            units, vectors = stacked(points["unit"]), stacked(points["vector"])
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            tree, keys = Tree(stacked(points["near"])), points["keys"]
            asked_units, asked_near, asked_vectors = stacked(wanted["unit"]), stacked(wanted["near"]), stacked(wanted["vector"])
            for i, (query, query_id, bound) in enumerate(zip(*(wanted[c].to_pylist() for c in ("query", "query_id", "bound")), strict=True)):
                # One more than k: the query itself is among them.
                places, far = search(tree, units, asked_near[i], asked_units[i], k + 1, limit, bound)
                mine = asked_vectors[i]
                length = math.sqrt(float(mine @ mine))
                for place, d in zip(places, far, strict=True):
                    score = float(vectors[place] @ mine) / (float(norms[place]) * length)
                    out += [(query, query_id, other, float(d), score) for other in keys[int(place)].as_py() if other != query_id]
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)], ["query", "query_id", "key", "far", "score"])

    return held.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInArrow(one, "query long, query_id long, key long, far double, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
