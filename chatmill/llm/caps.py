"""Near-duplicate vectors by spherical-cap filters."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.components import components
from chatmill.llm.minhash import forest, grouped
from chatmill.llm.vectors import dimension, directions, stacked, usable
from chatmill.llm.worker import kept
from chatmill.operators.staging import stage

# Vectors that an average filter should hold, and filters of a rotation that an average vector should pass.
PER_FILTER, PER_ROTATION = 48, 1
# Chance that a pair just near enough has no filter in common. There are as many rotations as that takes.
MISS = 1e-6
# Pairs and codes that the chance of one rotation is measured with; below so many components the space is not cut in two.
TRIALS, CODES, CUT = 64, 64, 8
# Members of a filter that are compared with as many others in one task.
BLOCK = 1024
# Possible links of a group, for each of its members, up to which they are passed on as pairs.
LINKS = 8
# Vectors that are decoded at a time, and inner products with filters held at a time.
BATCH, PRODUCTS = 512, 1 << 22


def cap_limit(share: float, size: int) -> float:
    """The inner product that a random direction has with a vector of length 1, of `size` components, with the chance `share`."""
    if size == 1:
        return 0.5
    angle = np.linspace(0, math.pi, 1 << 17)
    density = np.sin(angle) ** (size - 2)
    area = np.concatenate([[0.0], np.cumsum(density[1:] + density[:-1])])
    return math.cos(np.interp(share, area / area[-1], angle))


def cap_share(limit: float, size: int) -> float:
    """The inverse of `cap_limit`."""
    if size == 1:
        return 0.5
    angle = np.linspace(0, math.pi, 1 << 17)
    density = np.sin(angle) ** (size - 2)
    area = np.concatenate([[0.0], np.cumsum(density[1:] + density[:-1])])
    return float(np.interp(math.acos(limit), angle, area / area[-1]))


@dataclass(frozen=True)
class Filters:
    """Directions of a product code in several rotations, and how near a vector must come to pass.

    In each rotation the space is cut in two; a direction is a pair of random directions, one for each half. The inner product
    of a vector with a direction is a sum of two, so all directions beyond the limit are listed from the products of the
    halves, without trying all pairs. Spaces of few components are not cut: there the right half is empty, with one direction.
    """

    size: int  # components of a vector
    half: int  # directions of each half
    limit: float  # inner product at which a direction holds a vector
    rotations: int
    seed: int = 42

    @staticmethod
    def fit(vectors: int, size: int, least: float = 0.95) -> Filters:
        """Filters for so many vectors, of which a pair at the cosine `least` has none in common with a chance of MISS.

        A cap holds PER_FILTER of evenly spread vectors, more if it would be narrower than the pair. Rotations are drawn
        independently of each other and of the vectors, so whatever the pair is, the chance is the power of that of one rotation; this
        one is measured on random pairs and codes, and taken at three standard errors above the mean. Caps that too few pairs
        share are widened.
        """
        share = min(0.25, PER_FILTER / max(vectors, 1))
        while True:
            limit = min(cap_limit(share, size), max(least, 0.0))
            share = max(share, cap_share(limit, size))
            count = max(16.0, PER_ROTATION / share)
            one = Filters(size, math.ceil(math.sqrt(count) if size >= CUT else count), limit, 1)
            chance = one.missed(least)
            if chance < 0.9 or share >= 0.5:
                break
            share = min(0.5, share * 2)
        if chance >= 1:
            raise ValueError(f"no filters find pairs at cosine {least}")
        return Filters(size, one.half, limit, math.ceil(math.log(MISS) / math.log(max(chance, MISS))))

    def missed(self, least: float) -> float:
        """The chance that a pair at the cosine `least` shares no filter of one rotation, three standard errors added."""
        none = np.zeros(CODES)
        for k in range(CODES):
            rng = np.random.default_rng([self.seed, k, 1])
            left, right = self._halves(rng)
            x, y = directions(rng.standard_normal((TRIALS, self.size))), rng.standard_normal((TRIALS, self.size))
            if self.size > 1:
                y = directions(y - (x * y).sum(axis=1, keepdims=True) * x)
                y = least * x + math.sqrt(max(0.0, 1 - least * least)) * y
            else:
                y = x if least > -1 else -x
            pairs = [Filters._sums(v, left, right) for v in (x, y)]
            for t in range(TRIALS):
                # Only directions that can reach the limit with the best of the other half, for both vectors.
                rows = np.logical_and.reduce([a[t] >= self.limit - b[t].max() for a, b in pairs])
                columns = np.logical_and.reduce([b[t] >= self.limit - a[t].max() for a, b in pairs])
                both = np.logical_and.reduce([a[t][rows][:, None] + b[t][columns][None, :] >= self.limit for a, b in pairs])
                none[k] += not both.any()
        none /= TRIALS
        return float(none.mean() + 3 * none.std() / math.sqrt(CODES))

    @property
    def cut(self) -> int:
        return self.size // 2 if self.size >= CUT else self.size

    def _halves(self, rng: np.random.Generator) -> list[np.ndarray]:
        halves = [rng.standard_normal((self.half, self.cut)), rng.standard_normal((self.half if self.cut < self.size else 1, self.size - self.cut))]
        return [h * (math.sqrt(h.shape[1] / self.size) / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-300)) for h in halves]

    @staticmethod
    def _sums(units: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = left.shape[1]
        return units[:, :cut] @ left.T, units[:, cut:] @ right.T

    def codes(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rotation, left, right) for each rotation."""
        out = []
        for r in range(self.rotations):
            rng = np.random.default_rng([self.seed, r])
            turn, upper = np.linalg.qr(rng.standard_normal((self.size, self.size)))
            out.append((turn * np.sign(np.diag(upper)), *self._halves(rng)))
        return out

    def decode(self, units: np.ndarray, codes: list) -> list[np.ndarray]:
        """For each vector of length 1 the sorted numbers of all filters that hold it."""
        owners, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r, (turn, left, right) in enumerate(codes):
            a, b = self._sums(units @ turn, left, right)
            # Left directions that reach the limit with the best right one: few of all.
            at, lefts = np.nonzero(a >= self.limit - b.max(axis=1, keepdims=True))
            step = max(1, PRODUCTS // len(right))
            for low in range(0, len(at), step):
                i, j = at[low : low + step], lefts[low : low + step]
                k, rights = np.nonzero(a[i, j][:, None] + b[i] >= self.limit)
                owners.append(i[k])
                numbers.append((r * self.half + j[k]) * self.half + rights)
        owner, number = np.concatenate(owners), np.concatenate(numbers)
        order = np.lexsort((number, owner))
        return np.split(number[order], np.cumsum(np.bincount(owner, minlength=len(units)))[:-1]) if len(units) else []


def filter_lists(df: DataFrame, filters: Filters, vector: str = "unit", out: str = "filters") -> DataFrame:
    """Add the numbers of the filters that hold a vector of length 1 (array<long>, sorted; empty if none does)."""
    ship(df.sparkSession)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codes = kept("caps", filters, filters.codes)
        for vectors in batches:
            lists: list[np.ndarray] = []
            for low in range(0, len(vectors), BATCH):
                lists += filters.decode(stacked(vectors.slice(low, BATCH)), codes)
            yield pa.array(lists, pa.list_(pa.int64()))

    return df.withColumn(out, decode(F.col(vector)))


def _unit_column(df: DataFrame, vector: str, out: str) -> DataFrame:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def unit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield pa.array(list(directions(stacked(vectors))), pa.list_(pa.float64())) if len(vectors) else pa.array([], pa.list_(pa.float64()))

    return df.withColumn(out, unit(F.col(vector)))


def _sketch_type(size: int, width: int) -> np.dtype:
    return np.dtype([("scale", "<f4"), ("error", "<f4"), ("parts", f"<i{width}", (size,))])


def sketches(units: np.ndarray, width: int = 1) -> np.ndarray:
    """Each vector of length 1 in `width` bytes for each component: `scale` times `parts` is off by a vector no longer than `error`."""
    out = np.zeros(len(units), _sketch_type(units.shape[1], width))
    most = (1 << 8 * width - 1) - 1
    out["scale"] = np.abs(units).max(axis=1) / most
    scale = out["scale"].astype(np.float64)[:, None]
    out["parts"] = np.clip(np.rint(units / scale), -most, most)
    # Rounded up: what doubles and 32 bits lose is far less than is added.
    out["error"] = np.linalg.norm(units - scale * out["parts"], axis=1) * (1 + 1e-6) + 1e-9
    return out


def _sketch_rows(column: pa.ChunkedArray, size: int, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _sketch_type(size, width))


def between(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the sketches of `left` and `right`, and how far those of the vectors may be from them."""
    x, y = (s["parts"].astype(np.float64) * s["scale"].astype(np.float64)[:, None] for s in (left, right))
    a, b = (s["error"].astype(np.float64) for s in (left, right))
    return x @ y.T, a[:, None] + b + a[:, None] * b + 1e-9


def _sketch_column(df: DataFrame, vector: str, out: str, width: int) -> DataFrame:
    @F.arrow_udf(T.BinaryType())
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield pa.array([s.tobytes() for s in sketches(stacked(vectors), width)] if len(vectors) else [], pa.binary())

    return df.withColumn(out, sketch(F.col(vector)))


def shares_earlier(left: list[np.ndarray], right: list[np.ndarray], here: int) -> np.ndarray:
    """Boolean matrix: which rows of `left` and of `right` have a filter below `here` in common."""
    width = len(left)
    lists = [f[: np.searchsorted(f, here)] for f in (*left, *right)]
    owner = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    _, at, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    use = times[at] > 1
    owner, at = owner[use], at[use]
    _, at = np.unique(at, return_inverse=True)
    both = np.zeros((width, len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        i, j = np.searchsorted(at, [low, low + 4096])
        mark = np.zeros((len(lists), min(4096, int(at[-1]) + 1 - low)), np.float32)
        mark[owner[i:j], at[i:j] - low] = 1
        both += mark[:width] @ mark[width:].T
    return both > 0


def _in_blocks(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Add (i, j, side): the members of each of `buckets` in as many blocks as it needs, a row for each pair of blocks."""
    large = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > BLOCK).select("bucket", F.ceil(F.col("m") / BLOCK).cast("long").alias("blocks"))
    # Few filters need several blocks; written, Spark knows that there are few, and does not shuffle the rows for this join.
    rows = rows.join(stage(large, "cap-blocks"), "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("blocks", "other")


def _meet(rows: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b, sure) for each group (bucket, i, j): the pairs that may be linked, by their sketches, and whether they surely are.

    A group with more than LINKS of them for each member passes on none but (bucket, null, null).
    """
    def one(group: pa.Table) -> tuple[list, list, list] | None:
        ids, sides = group["id"].to_numpy(), group["side"].to_numpy()
        bucket, i, j = (group[c][0].as_py() for c in ("bucket", "i", "j"))
        every = np.arange(len(ids))
        left, right = (every, every) if i == j else (np.flatnonzero(sides == i), np.flatnonzero(sides == j))
        if len(ids) < 2 or not len(left) or not len(right):
            return None
        short = _sketch_rows(group["sketch"], size, 1)
        cosine, error = between(short[left], short[right])
        near = cosine >= least - error
        if i == j:
            near = np.triu(near, 1)
        x, y = np.nonzero(near)
        if len(x) > LINKS * len(ids):
            return [bucket], [None], [None]
        a, b = ids[left[x]], ids[right[y]]
        return np.minimum(a, b), np.maximum(a, b), cosine[x, y] >= least + error[x, y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            if (found := one(group)) is not None and len(found[0]):
                a, b, sure = found
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure, pa.bool_())], ["a", "b", "sure"])

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long, sure boolean")


def _compare(rows: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b, n, j) for each group (bucket, i, j): its links counted for each member as (id, id, n), and links (a, b, 0) that connect it.

    A pair counts in the first filter that both have, so once in all; `filters` has a member's filters before the group's. Pairs
    that the sketches leave open are passed on as (a, b, -1); with more than LINKS of them for each member, (bucket, null, i, j) is
    instead. Rows with a `unit` have those pairs compared, and no others.
    """
    whole = "unit" in rows.columns

    def one(group: pa.Table) -> Iterator[tuple]:
        ids, sides, copies = (group[c].to_numpy() for c in ("id", "side", "copies"))
        bucket, i, j = (group[c][0].as_py() for c in ("bucket", "i", "j"))
        every = np.arange(len(ids))
        left, right = (every, every) if i == j else (np.flatnonzero(sides == i), np.flatnonzero(sides == j))
        if len(ids) < 2 or not len(left) or not len(right):
            return
        short = _sketch_rows(group["sketch"], size, 2)
        cosine, error = between(short[left], short[right])
        near, linked = cosine >= least - error, cosine >= least + error
        if i == j:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        lists = [np.asarray(f.values) for f in group["filters"]]
        first = near & ~shares_earlier([lists[x] for x in left], [lists[x] for x in right], bucket)
        if whole:
            units = stacked(group["unit"])
            linked = first & ~linked & (units[left] @ units[right].T >= least)
        else:
            x, y = np.nonzero(np.triu(first & ~linked) if i == j else first & ~linked)
            if len(x) > LINKS * len(ids):
                yield [bucket], [None], [i], [j]
            elif len(x):
                a, b = ids[left[x]], ids[right[y]]
                yield np.minimum(a, b), np.maximum(a, b), np.full(len(a), -1), np.zeros(len(a), np.int64)
            linked &= near
        counted = first & linked
        counts = np.zeros(len(ids), np.int64)
        np.add.at(counts, left, counted @ copies[right])
        if i != j:
            np.add.at(counts, right, counted.T @ copies[left])
        some = np.flatnonzero(counts)
        yield ids[some], ids[some], counts[some], np.zeros(len(some), np.int64)
        if links := forest(len(ids), left, right, linked):
            a, b = np.array(links).T
            yield ids[a], ids[b], np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            for part in one(group):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in part], ["a", "b", "n", "j"])

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long, n long, j long")


def _links(held: DataFrame, size: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(id, n), the copies of members linked with a member, and (a, b), enough links to connect all that are linked.

    `held` has id, copies, unit, filters, and sketches of one byte (`short`) and two (`sketch`). Members first meet by the short ones.
    Filters with very many pairs are then gone through as matrices, and a pair that shares such a filter counts there.
    Pairs that the sketches leave open are compared on all components.
    """
    met = held.select("id", F.explode("filters").alias("bucket"), F.col("short").alias("sketch"))
    found = stage(_meet(_in_blocks(met, held.select(F.explode("filters").alias("bucket"))), size, least), "cap-meetings")
    pairs = found.filter(F.col("b").isNotNull()).groupBy("a", "b").agg(F.max("sure").alias("sure"))

    dense = found.filter(F.col("b").isNull()).select(F.col("a").alias("bucket")).distinct()
    whole = None
    if not dense.isEmpty():
        lists = held.select("id", F.explode("filters").alias("bucket")).join(dense, "bucket")
        lists = stage(lists.groupBy("id").agg(F.sort_array(F.collect_list("bucket")).alias("filters")), "cap-dense")
        most = lists.agg(F.max(F.element_at("filters", -1))).first()[0]
        kind = "array<int>" if most < 1 << 31 else "array<long>"
        rows = lists.withColumn("filters", F.col("filters").cast(kind)).join(held.select("id", "copies", "sketch"), "id")
        rows = rows.select("id", "copies", "sketch", "filters", F.posexplode("filters").alias("at", "bucket"))
        rows = rows.withColumn("filters", F.slice("filters", F.lit(1), F.col("at"))).withColumn("bucket", F.col("bucket").cast("long")).drop("at")
        rows = _in_blocks(rows, lists.select(F.explode("filters").alias("bucket")))
        whole = stage(_compare(rows, size, least), "cap-links")
        tied = whole.filter(F.col("b").isNull()).select(F.col("a").alias("bucket"), F.col("n").alias("i"), "j")
        if not tied.isEmpty():
            more = rows.join(tied, ["bucket", "i", "j"]).join(held.select("id", "unit"), "id")
            whole = whole.filter(F.col("b").isNotNull()).unionByName(stage(_compare(more, size, least), "cap-links"))
        for end in ("a", "b"):
            pairs = pairs.join(lists.select(F.col("id").alias(end), F.col("filters").alias(f"dense_{end}")), end, "left")
        pairs = pairs.filter(~F.coalesce(F.arrays_overlap("dense_a", "dense_b"), F.lit(False))).select("a", "b", "sure")
        pairs = pairs.unionByName(whole.filter("n = -1").select("a", "b", F.lit(False).alias("sure")))
    pairs = stage(pairs, "cap-pairs")

    # Written for the same reason as the blocks.
    open_ = stage(pairs.filter(~F.col("sure")).select("a", "b"), "cap-open")
    for end in ("a", "b"):
        open_ = open_.join(held.select(F.col("id").alias(end), F.col("unit").alias(f"unit_{end}")), end)
    cosine = F.aggregate(F.zip_with("unit_a", "unit_b", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    linked = stage(pairs.filter("sure").select("a", "b").unionByName(open_.filter(cosine >= least).select("a", "b")), "cap-linked")

    ends = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = ends.join(held.select(F.col("id").alias("b"), "copies"), "b").select(F.col("a").alias("id"), F.col("copies").alias("n"))
    if whole is not None:
        counts = counts.unionByName(whole.filter("n > 0").select(F.col("a").alias("id"), "n"))
        linked = linked.unionByName(whole.filter("n = 0").select("a", "b"))
    return counts.groupBy("id").agg(F.sum("n").alias("n")), linked


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of `df`.

    Vectors are linked if their cosine, in double precision, is `least` or more. `n_links` counts the other rows linked with a
    row, `component_id` is the smallest key reachable by links, itself included, and `kept` says that it is the row's own.
    Vectors that are null, empty, zero or hold null or non-finite components have no links. Rows of equal key are vectors
    of their own. A null key takes no part: its component is null and it is kept. Vectors of unequal lengths are an error.

    Rows of equal components are one member with a number of copies. Each member goes to every filter direction that it
    exceeds, as a sketch of one byte for each component. Members that meet in a filter are compared by these, in blocks of bounded
    size, which pass on at most LINKS pairs for each member. Filters with more are gone through again with two bytes for each
    component, and pass on one count for each member and enough links to connect them. What the error bounds of
    sketches leave open is compared on all components. A pair that shares no filter is missed: at the cosine `least` with a chance
    of MISS, nearer ones with less, whatever the number of vectors and of their components.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    fine = rows.filter(F.col("key").isNotNull() & usable(F.col("vector")))
    plain = fine.select("key", F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    size = dimension(plain, "vector")
    members = plain.groupBy("vector").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"))
    members = stage(members.withColumn("id", F.monotonically_increasing_id()), "vectors")
    if size is None:
        return df.select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    units = _unit_column(members.select("id", "copies", "vector"), "vector", "unit").drop("vector")
    units = _sketch_column(_sketch_column(units, "unit", "short", 1), "unit", "sketch", 2)
    held = stage(filter_lists(units, Filters.fit(members.count(), size, least)), "caps")
    counts, links = _links(held, size, least)

    slim = members.select("id", "first", "copies").join(counts, "id", "left").join(components(links), "id", "left")
    slim = slim.select("id", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    slim = slim.join(slim.groupBy("component").agg(F.min("first").alias("component_id")), "component").select("id", "n_links", "component_id")
    known = members.select("id", "vector").join(slim, "id").drop("id")
    # Equal vectors find their member by its components; a vector with very many copies is one row on that side, so Spark can split the other.
    named = plain.join(known, "vector").select("key", "n_links", "component_id")
    others = rows.filter(F.col("key").isNull() | ~usable(F.col("vector"))).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = named.unionByName(others)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("key"), F.lit(True)).alias("kept"))
