"""Vectors as packed doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not empty, not zero and holds finite components only."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def stacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix of doubles; all have equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1)


def directions(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))



def dimension(df: DataFrame, vector: str) -> int | None:
    """Components of the usable vectors; None without any, an error if they differ."""
    row = df.agg(F.min(F.size(vector)).alias("low"), F.max(F.size(vector)).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors have {row['low']} to {row['high']} components")
    return row["low"]
