"""Vectors as short codes: product codebooks over integers, assigned through dictionaries of the values in each dimension."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.deploy import ship
from chatmill.llm.vectors import dimension, stacked
from chatmill.operators.staging import stage

# Rows whose value dictionaries are made together; bounds the tables of a task, not what is computed.
TOGETHER = 4096
# Integers are held within this bound, so that all squared distances of a vector add up within 64 bits (up to 512 components).
LARGEST = 1 << 26


class Codes(NamedTuple):
    """`rows`: the input without unusable vectors, with `code` (binary) and `error`; `codebooks`: parts x entries x components."""

    rows: DataFrame
    codebooks: np.ndarray


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as longs within ±LARGEST, null for a vector that is null, empty or holds null or non-finite
    components. A zero vector is as good as others."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    held = F.transform(vector, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * scale))).cast("long"))
    return F.when(~wrong & (F.size(vector) > 0), held)


def nearest_entries(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of integers the nearest entry, ties to the lower index, and its squared distance.

    In each dimension the distinct integers are the dictionary; their squared differences to all entries are tabulated once,
    and the distances of a row are the sum of the table rows its dictionary codes name.
    """
    total = None
    for d in range(part.shape[1]):
        values, codes = np.unique(part[:, d], return_inverse=True)
        gaps = values[:, None] - entries[None, :, d]
        gathered = (gaps * gaps)[codes]
        total = gathered if total is None else np.add(total, gathered, out=total)
    best = total.argmin(axis=1)
    return best, total[np.arange(len(part)), best]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums): what each task's parts add to the entries they are nearest to, one row a task, part and entry used."""
    parts, size, width = books.shape

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, size), np.int64), np.zeros(books.shape, np.int64)
        for batch in _blocks(batches):
            numbers = stacked_longs(batch.column(0)).reshape(-1, parts, width)
            for p in range(parts):
                best, _ = nearest_entries(numbers[:, p], books[p])
                n[p] += np.bincount(best, minlength=size)
                np.add.at(sums[p], best, numbers[:, p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"]
        )

    made = rows.select("numbers").mapInArrow(added, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]
    return made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)


def stacked_longs(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def compress(df: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codes:
    """Code every vector by the nearest codebook entry of each of its equal consecutive parts.

    Components become floor(scale * x). Codebooks start as the parts of the rows with the `entries` smallest keys (null keys last, ties by the
    vector), fewer if there are fewer rows, and are replaced `rounds` times by the componentwise floor of the mean of the parts
    nearest to them; an unused entry stays. `error` is the squared distance of the vector to its code, all in integers.

    Rows whose vector is null, empty or holds null or non-finite components are left out; without any row left the result is
    empty. Vectors of unequal lengths, or of a length that is no multiple of `parts`, are an error. Components beyond ±LARGEST / scale count as
    that bound. Rows of equal key are vectors of their own; other columns are handed on, whatever their
    names; `code` and `error` replace columns of these names.

    A round reads the integers, adds up inside each task, and shuffles a row per task, part and entry; the codebooks, whose size
    the parameters fix, are all that passes through the driver.
    """
    spark = ship(df.sparkSession)
    numbered = df.withColumn("__numbers", whole_numbers(F.col(vector), scale)).filter(F.col("__numbers").isNotNull())
    rows = numbered.select(F.col(key).alias("key"), F.col("__numbers").alias("numbers"))
    width = dimension(rows, "numbers")
    kept = [c for c in df.columns if c not in ("code", "error")]
    if width is None:
        return Codes(numbered.select(*kept, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64))
    if width % parts:
        raise ValueError(f"{width} components are no {parts} equal parts")
    rows = stage(rows, "numbers")
    first = rows.orderBy(F.asc_nulls_last("key"), "numbers").limit(entries).select("numbers").collect()
    books = np.array([r["numbers"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(rows, books).collect():
            books[r["part"], r["entry"]] = [r[f"s{d}"] // r["n"] for d in range(books.shape[2])]

    held = spark.sparkContext.broadcast(books)

    @F.arrow_udf("struct<code: binary, error: long>")
    def coded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        final = held.value
        for column in columns:
            codes, errors = np.zeros((len(column), parts), np.uint8 if final.shape[1] <= 256 else ">u2"), np.zeros(len(column), np.int64)
            for at in range(0, len(column), TOGETHER):
                numbers = stacked_longs(column.slice(at, TOGETHER)).reshape(-1, parts, final.shape[2])
                for p in range(parts):
                    best, gap = nearest_entries(numbers[:, p], final[p])
                    codes[at : at + TOGETHER, p] = best
                    errors[at : at + TOGETHER] += gap
            yield pa.StructArray.from_arrays([pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors)], ["code", "error"])

    return Codes(numbered.withColumn("__c", coded("__numbers")).select(*kept, "__c.code", "__c.error"), books)


def decompress(rows: DataFrame, codebooks: np.ndarray, code: str = "code", name: str = "decoded", scale: int = 256) -> DataFrame:
    """Add the vector that a code stands for: the middle of its integers' cells, divided by the scale again; null for a null code."""
    ship(rows.sparkSession)
    parts, size, _ = codebooks.shape
    held = rows.sparkSession.sparkContext.broadcast((codebooks + 0.5) / scale)

    @F.arrow_udf("array<double>")
    def decoded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = [None if c is None else np.concatenate(held.value[np.arange(parts), np.frombuffer(c, np.uint8 if size <= 256 else ">u2")]) for c in column.to_pylist()]
            yield pa.array(out, pa.list_(pa.float64()))

    return rows.withColumn(name, decoded(code))
