"""Merging datasets kept as JSON lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.operators.combine import merge_sources, record_counts
from chatmill.operators.ordering import number_rows, seeded_shuffle
from chatmill.sources.files import path_exists
from chatmill.sources.jsonl import read_tolerant
from chatmill.sources.sinks import write_lines


def merge_rejects(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(`source`, `file`, `line_no`, `line`, `reason`) of the lines that `merge_files` leaves out."""
    return reduce(DataFrame.unionByName, [read_tolerant(spark, p)[1].withColumn("source", F.lit(p)) for p in paths]).select("source", "file", "line_no", "line", "reason")


def merge_files(spark: SparkSession, paths: list[str], shuffle_seed: int | None = None) -> DataFrame:
    """Readable lines of all files in input order, or shuffled; (`source`, `source_no`, `row_no`, `line`).

    `row_no` is the place in input order. A missing file is an error, an unreadable line is left out (see `merge_rejects`).
    """
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"input not found: {', '.join(missing)}")
    merged = merge_sources({p: read_tolerant(spark, p, line_numbers=False)[0] for p in paths})
    placed = number_rows(merged, ["source_no", "file", "seq"]).drop("file", "seq")
    if shuffle_seed is not None:
        return seeded_shuffle(placed, shuffle_seed, ["row_no"])
    return placed.repartitionByRange("row_no").sortWithinPartitions("row_no")


def prepare_merge(spark: SparkSession, paths: list[str], out: str, shuffle_seed: int | None = None, dry: bool = False) -> DataFrame:
    """The whole job: merged lines written, or only counted in a `dry` run; (`source`, `records`) per input. Without any line it is an error and nothing is written."""
    merged = merge_files(spark, paths, shuffle_seed)
    counts = record_counts(merged, "source")
    if dry:
        return counts
    write_lines(merged, out, may_be_empty=False)
    return counts
