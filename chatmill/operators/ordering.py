"""Total orders: numbering, seeded shuffle and row cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.keys import hash_number, seeded_key
from chatmill.operators.staging import stage

# monotonically_increasing_id holds the partition above these bits and the row's place in it below.
_ROW_BITS = 33

# A selection by rank: rows gathered for an exact order, bins counted in a round, keys sampled to cut them.
GATHERED, BINS, SAMPLED = 20_000, 256, 4096


def _columns(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _number_placed(placed: DataFrame, name: str) -> DataFrame:
    """Number rows that already lie in order within and across partitions.

    One pass writes the rows with their places, a count per partition gives the offsets. There are as
    many offsets as partitions, so they are small enough to broadcast at any data size.
    """
    staged = stage(placed.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", _ROW_BITS)
    sizes = staged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        staged.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("__part", "__at", "__before")
    )


def number_rows(df: DataFrame, order: list[Column | str], name: str = "row_no") -> DataFrame:
    """Add the row's place (from 0) in the given order, without a one-partition window.

    `order` must tell rows apart: its last column should be an id, so that equal leading values
    can be spread over several range partitions.
    """
    cols = _columns(order)
    return _number_placed(df.repartitionByRange(*cols).sortWithinPartitions(*cols), name)


def _slots(df: DataFrame, seed: int, ids: list[str], partitions: int | None) -> tuple[int, DataFrame]:
    """Rows with their hash `__key` and its `__slot`: md5 values are spread evenly, so equal slices of the hash range are
    balanced partitions, and unlike a global sort this needs no sampling pass over the input."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__key", seeded_key(seed, *ids))
    return n, keyed.withColumn("__slot", F.shiftright(hash_number(F.col("__key")) * n, 32).cast("int"))


def _placed_by_hash(df: DataFrame, seed: int, ids: list[str], partitions: int | None) -> DataFrame:
    n, keyed = _slots(df, seed, ids, partitions)
    return keyed.repartitionById(n, F.col("__slot")).sortWithinPartitions("__key", *ids).drop("__key")


def seeded_shuffle(df: DataFrame, seed: int, ids: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in a random order fixed by the seed and the row ids, whatever the partitioning.

    The order runs through the partitions one after another and is what a sink writes out.
    `ids` must identify a row.
    """
    return _placed_by_hash(df, seed, ids, partitions).drop("__slot")


def number_shuffled(df: DataFrame, seed: int, ids: list[str], name: str = "row_no", partitions: int | None = None) -> DataFrame:
    """`seeded_shuffle` with the place in the shuffled order as a column.

    How many rows each slot of the hash range holds follows from the ids alone, so rows are shuffled once and not written
    in between; one offset per slot is broadcast.
    """
    n, keyed = _slots(df.select(*ids), seed, ids, partitions)
    sizes = keyed.groupBy("__slot").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = _placed_by_hash(df, seed, ids, n).withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "__slot").withColumn(name, F.col("__before") + F.col("__at")).drop("__slot", "__at", "__before")


def _literal(value, kind: T.DataType) -> Column:
    """A value as collected, as a column of its type."""
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def _bin(key: Column, pivots: list[Column], low: int = 0) -> Column:
    """Place among sorted pivots, by bisection: 2 i between pivot i - 1 and pivot i, 2 i + 1 at pivot i."""
    if not pivots:
        return F.lit(2 * low)
    middle = len(pivots) // 2
    upper = F.when(key == pivots[middle], 2 * (low + middle) + 1).otherwise(_bin(key, pivots[middle + 1 :], low + middle + 1))
    return F.when(key < pivots[middle], _bin(key, pivots[:middle], low)).otherwise(upper)


def nth_key(keys: DataFrame, rank: int, weight: str | None = None) -> tuple[Column, int] | None:
    """The key (column `key`) at a rank from 1 in ascending order, as a literal, and how much of the rank falls on the row it was found at; None if the
    keys, or their weights, don't reach the rank.

    With `weight`, a column of whole numbers, a row counts so many times. Nothing is sorted as a whole or written: a rank within the first GATHERED rows
    is a top-k. Beyond, each round samples keys of the range that holds the rank, counts the rows at and between BINS of them, and goes on in
    one bin, until that is GATHERED rows or one key. A round reads the key columns twice.
    """
    kind = keys.schema["key"].dataType
    rows = keys.withColumn("__w", F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")).filter("__w > 0")

    def gathered(some: DataFrame, left: int) -> tuple[Column, int] | None:
        for r in some.orderBy("key").limit(min(left, GATHERED)).select("key", "__w").collect():
            if left <= r["__w"]:
                return _literal(r["key"], kind), left
            left -= r["__w"]
        return None

    if rank <= GATHERED:
        return gathered(rows, rank)
    total = rows.agg(F.sum("__w").alias("w"), F.count(F.lit(1)).alias("n")).first()
    if (total["w"] or 0) < rank:
        return None
    some, left, n = rows, rank, total["n"]
    while n > GATHERED:
        sample = some.select("key").sample(min(1.0, 2 * SAMPLED / n), 1).limit(SAMPLED).distinct().sort("key").collect()
        pivots = [_literal(sample[i]["key"], kind) for i in sorted({len(sample) * b // BINS for b in range(BINS)})]
        bins = some.groupBy(_bin(F.col("key"), pivots).alias("bin")).agg(F.sum("__w").alias("w"), F.count(F.lit(1)).alias("n"))
        for r in sorted(bins.collect(), key=lambda r: r["bin"]):
            if left <= r["w"]:
                break
            left -= r["w"]
        i, n = r["bin"] // 2, r["n"]
        if r["bin"] % 2:
            return pivots[i], left
        # The pivots themselves are out, so the range is smaller each time.
        some = some.filter(F.col("key") > pivots[i - 1]) if i else some
        some = some.filter(F.col("key") < pivots[i]) if i < len(pivots) else some
    return gathered(some, left)


def first_rows(df: DataFrame, order: list[Column | str], n: int | None) -> DataFrame:
    """The first `n` rows, in the given order; None keeps all rows, n < 1 is refused.

    The n-th order key is found from the order columns alone, whatever n is; rows up to it are kept. `order` must tell rows
    apart, and its columns must sort ascending. Whole rows are read once, after that, and sorted over all tasks.
    """
    if n is None:
        return df
    if n < 1:
        raise ValueError("a row cap must be at least 1; use None for all rows")
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_columns(order))])
    last = nth_key(df.select(key.alias("key")), n)
    kept = df if last is None else df.filter(key <= last[0])
    return kept.orderBy(*_columns(order))


def number_samples(df: DataFrame, order: list[Column | str], name: str = "sample") -> DataFrame:
    """Add the name `sample_<n>`, n counting from 0 in the given order."""
    return number_rows(df, order, "__row").withColumn(name, F.concat(F.lit("sample_"), F.col("__row").cast("string"))).drop("__row")


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row with the median (mean of the two middle values) of the non-null values; null without any. Found by counting, see `nth_key`."""
    values = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("key"))
    n = values.count()
    if not n:
        return df.sparkSession.createDataFrame([(None,)], "median double")
    low = nth_key(values, (n + 1) // 2)[0]
    both = values.agg(F.count_if(F.col("key") <= low).alias("upto"), F.min(F.when(F.col("key") > low, F.col("key"))).alias("next"))
    high = F.when(F.lit(n % 2 == 1) | (F.col("upto") > n // 2), low).otherwise(F.col("next"))
    return both.select(((low + high) / 2).alias("median"))
