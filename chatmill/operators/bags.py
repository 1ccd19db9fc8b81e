"""Multiset overlap of long texts by exploding tokens into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.metrics import f_measure


def bag_scores(df: DataFrame, ids: list[str], pred: Column, ref: Column, name: str = "token_f1") -> DataFrame:
    """F-measure of two token arrays per row id, as (`ids`, `overlap`, `name`).

    The table form of the row-wise score: tokens are counted per row id and token before the shuffle, so
    neither a very long text nor a very frequent token meets in one task. `ids` must identify a row.
    """
    side = F.explode(
        F.concat(
            F.transform(F.coalesce(pred, F.array().cast("array<string>")), lambda t: F.struct(t.alias("token"), F.lit(1).alias("p"), F.lit(0).alias("r"))),
            F.transform(F.coalesce(ref, F.array().cast("array<string>")), lambda t: F.struct(t.alias("token"), F.lit(0).alias("p"), F.lit(1).alias("r"))),
            # One row that counts nothing, so that a row without any token comes out too.
            F.array(F.struct(F.lit(None).cast("string").alias("token"), F.lit(0).alias("p"), F.lit(0).alias("r"))),
        )
    )
    tokens = df.select(*ids, side.alias("t")).groupBy(*ids, "t.token").agg(F.sum("t.p").alias("p"), F.sum("t.r").alias("r"))
    sums = tokens.groupBy(*ids).agg(F.sum(F.least("p", "r")).alias("overlap"), F.sum("p").alias("n_pred"), F.sum("r").alias("n_ref"))
    score = F.coalesce(f_measure(F.col("overlap"), F.col("n_pred"), F.col("n_ref")), F.lit(0.0))
    return sums.select(*ids, "overlap", score.alias(name))
