"""Merging datasets and counting records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Bag union in the given order, with the name as `source` and its place as `source_no`; duplicates stay."""
    if not sources:
        raise ValueError("no datasets to merge")
    named = [df.withColumns({"source": F.lit(n), "source_no": F.lit(i)}) for i, (n, df) in enumerate(sources.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def record_counts(df: DataFrame, by: str = "source", total: str = "total") -> DataFrame:
    """Records per source and a total row."""
    # Counted first, so that the roll-up doubles a row per source and not the rows themselves.
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).rollup(by).agg(F.sum("n").alias("records"), F.grouping(by).alias("__all"))
    return counted.select(F.when(F.col("__all") == 1, total).otherwise(F.col(by)).alias(by), "records")


def document_counts(samples: DataFrame, doc: str = "stem", block: str = "block_no") -> DataFrame:
    """Per document: raw question-and-answer blocks and the questions they were expanded to."""
    # Two steps, so that a document with very many questions is pre-counted by block.
    per_block = samples.groupBy(doc, block).agg(F.count(F.lit(1)).alias("n"))
    return per_block.groupBy(doc).agg(F.count(F.lit(1)).alias("raw"), F.sum("n").alias("expanded"))


def any_true(df: DataFrame, flag: Column, name: str) -> DataFrame:
    """One row: whether the flag holds for any row; false for an empty table."""
    return df.agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(name))
