"""Scoring replies as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chatmill.sources.snapshots import publish

# How often a job looks for new rows, in the words of DataStreamWriter.trigger: here once, for what is there. A job that
# follows a live run takes {"processingTime": "10 seconds"}.
ONCE = {"availableNow": True}


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def append_scored(
    rows: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Score arriving rows and append them; finished rows outlive a crash and are not scored twice."""
    writer = score(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start(out)


def rolling_summary(
    rows: DataFrame, keys: list[str], metrics: tuple[str, ...], out: str, checkpoint: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Keep a summary table current: rows, ok rows and metric means per key, published as a new version with every batch.

    The state is one row of sums per key. Means are over ok rows. Readers take snapshots.read_current(out), which is whole at any time.
    """
    ok = F.col("status") == "ok"
    means = [F.avg(F.when(ok, F.col(m))).alias(f"{m}_mean") for m in metrics]
    summary = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_total"), F.count_if(ok).alias("n_ok"), *means)

    def replace(batch: DataFrame, _: int) -> None:
        publish(batch, out)

    writer = summary.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(replace).trigger(**trigger).start()
