"""Training logs and result logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.operators.trainlog import dedup_series, latest_file
from chatmill.schemas import LOG_ENTRY, SCALARS
from chatmill.sources.files import path_exists


def read_log_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of JSON lines, with `__path`. Lines that are no object of this schema, such as one cut off by a crash, give none."""
    marked = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    row = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    rows = lines.filter(F.trim("value") != "").select(row.alias("r"), F.col("_metadata.file_path").alias("__path"))
    return rows.filter(F.col("r").isNotNull() & F.col("r.__bad").isNull()).select("r.*", "__path").drop("__bad")


def read_scalars(spark: SparkSession, folder: str, merge_runs: bool = False) -> DataFrame:
    """One value per tag and step of the scalar rows (JSON lines) below a folder.

    Without `merge_runs` only the file that comes last by its path is read, and of its rows those of the last name, if they carry one of their own
    (`file`); with it the last file wins per step.
    """
    below = spark.read.option("recursiveFileLookup", True)
    if merge_runs:
        lines = below.text(folder)
    else:
        last = latest_path(spark, folder)
        if last is None:
            return dedup_series(spark.createDataFrame([], SCALARS).withColumn("seq", F.lit(0)))
        lines = spark.read.text(last)
    rows = read_log_lines(lines, SCALARS)
    rows = rows.withColumns({"file": F.coalesce("file", "__path"), "seq": F.monotonically_increasing_id()}).drop("__path")
    return dedup_series(rows if merge_runs else latest_file(rows))


def latest_path(spark: SparkSession, folder: str) -> str | None:
    """The path that comes last by name of all files below a folder, found from their listing; none is opened. None without any file."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return listed.agg(F.max("path").alias("p")).first()["p"]


def read_checkpoint_history(spark: SparkSession, folder: str) -> DataFrame:
    """`log_history` of the checkpoint with the highest number; empty if that one has no readable state file."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/checkpoint-*")
    found = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(fs_path)
    numbers = [n for n in (s.getPath().getName().partition("-")[2] for s in found or [] if s.isDirectory()) if n.isdigit()]
    state = f"{folder.rstrip('/')}/checkpoint-{max(numbers, key=int)}/trainer_state.json" if numbers else None
    if state is None or not path_exists(spark, state):
        return spark.createDataFrame([], LOG_ENTRY)
    schema = T.StructType([T.StructField("log_history", T.ArrayType(LOG_ENTRY))])
    return spark.read.schema(schema).option("multiLine", True).json(state).select(F.explode("log_history").alias("e")).select("e.*")


def has_summary(spark: SparkSession, path: str) -> bool:
    """Whether a result log has a summary row."""
    flag = T.StructType([T.StructField("_summary", T.BooleanType())])
    return not read_log_lines(spark.read.text(path), flag).filter("_summary").isEmpty()


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result rows of a log; summary rows written into the same log are left out, and so is a line that a crash cut off."""
    flagged = T.StructType([*schema.fields, T.StructField("_summary", T.BooleanType())])
    rows = read_log_lines(spark.read.text(path), flagged).drop("__path")
    return rows.filter(~F.coalesce("_summary", F.lit(False))).drop("_summary")
