"""Pairing the two files of a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import strip


def pair_documents(docs: DataFrame, qa: DataFrame, key: str = "stem") -> DataFrame:
    """Documents with their Q&A text; both sides hold one row per key."""
    return docs.join(qa, key)


def orphans(docs: DataFrame, qa: DataFrame, key: str = "stem") -> DataFrame:
    """Documents without a Q&A text."""
    return docs.join(qa, key, "left_anti")


NO_TEXT = "no text file"
NO_JSON = "no json file"


def pair_folders(texts: DataFrame, jsons: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejects) per sample folder.

    Each side may hold several files (`file`) per folder: the first by name is used and `<side>_files`
    says how many there were. Rejects carry the `fault`.
    """

    def first(df: DataFrame, content: str, count: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min_by(content, "file").alias(content), F.count(F.lit(1)).alias(count))

    both = first(texts, "cv_text", "text_files").join(first(jsons, "json_text", "json_files"), keys, "full_outer")
    both = both.withColumn("fault", F.when(F.col("text_files").isNull(), NO_TEXT).when(F.col("json_files").isNull(), NO_JSON))
    pairs = both.filter(F.col("fault").isNull()).drop("fault").withColumn("cv_text", strip(F.col("cv_text")))
    return pairs, both.filter(F.col("fault").isNotNull()).select(*keys, "fault")
