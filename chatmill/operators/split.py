"""Train/eval split that keeps all rows of a group together and hits the group count exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.functions.keys import hash_number, seeded_key

TRAIN, EVAL = "train", "eval"
_DIGITS = 4  # hex digits of the first-level buckets: 65536 of them


def _cutoff(keys: DataFrame, share: float) -> DataFrame:
    """One row: the (hash, group) at rank max(1, round(n * share)), ties to even; error if it is the last.

    Groups are counted per hash slice, which is at most 65536 rows; only the slice that holds the wanted
    rank is ordered, and it holds about one 65536th of the groups as md5 spreads them evenly.
    """
    sized = keys.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    run = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranks = sized.select("slice", "n", F.sum("n").over(run).alias("end"), F.sum("n").over(every).alias("total"))
    wanted = F.greatest(F.lit(1).cast("bigint"), F.bround(F.col("total") * F.lit(share), 0).cast("bigint"))
    wanted = F.when(wanted < F.col("total"), wanted).otherwise(
        F.raise_error(F.lit("train split would be empty: use a smaller share or more groups")).cast("bigint")
    )
    found = ranks.withColumn("wanted", wanted).filter((F.col("wanted") <= F.col("end")) & (F.col("wanted") > F.col("end") - F.col("n")))
    found = found.select("slice", (F.col("wanted") - F.col("end") + F.col("n")).alias("place"))
    place = Window.partitionBy("slice").orderBy("hash", "grp")
    return (
        keys.join(F.broadcast(found), "slice")
        .withColumn("row", F.row_number().over(place))
        .filter(F.col("row") == F.col("place"))
        .select("hash", "grp")
    )


def with_split(df: DataFrame, group: Column | str, share: float, seed: int = 42, name: str = "split") -> DataFrame:
    """Add `train` or `eval`: the groups are put in seeded hash order and the first ones go to eval.

    The order position is found as a single cut-off value over the distinct groups, in a job of its own
    that runs now. The rows are labelled in place by comparing with that value: no join and no shuffle,
    however large a group is, and jobs over either side filter right at the scan.
    """
    if not 0 < share < 1:
        raise ValueError("the split share must lie between 0 and 1")
    group = F.col(group) if isinstance(group, str) else group
    key = seeded_key(seed, group)
    keys = df.select(group.cast("string").alias("grp")).distinct()
    keys = keys.withColumn("hash", seeded_key(seed, "grp")).withColumn("slice", hash_number(F.col("hash"), _DIGITS))
    last = _cutoff(keys, share).first()
    if last is None:
        raise ValueError("there are no groups to split")
    mine, cutoff = F.struct(key, group.cast("string")), F.struct(F.lit(last.hash), F.lit(last.grp).cast("string"))
    return df.withColumn(name, F.when(mine <= cutoff, EVAL).otherwise(TRAIN))


def group_split(df: DataFrame, group: Column | str, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, eval) rows of `with_split`."""
    labelled = with_split(df, group, share, seed, "__split")
    return tuple(labelled.filter(F.col("__split") == side).drop("__split") for side in (TRAIN, EVAL))
