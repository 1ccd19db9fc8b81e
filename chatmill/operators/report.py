"""Summaries of evaluation logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import truncate
from chatmill.operators.ordering import exact_median
from chatmill.schemas import METRICS, PRIMARY_METRIC, PROFILE_FIELDS, FieldSpec

OK, PARSE_ERROR, ERROR = "ok", "parse_error", "error"

# The score thresholds of the bands, the bin counts of the histograms, the width of the accuracy bar.
LOW, HIGH = 0.5, 0.8
SCORE_BINS, LATENCY_BINS = 25, 30
BAR_WIDTH = 20


def status_class(status: Column) -> Column:
    """`ok`, `parse_error`, or `error` for all else."""
    return F.when(status.isin(OK, PARSE_ERROR), status).otherwise(ERROR)


def band(score: Column) -> Column:
    return F.when(score < LOW, "low").when(score < HIGH, "middle").otherwise("high")


def accuracy_bar(share: Column) -> Column:
    return F.repeat(F.lit("█"), F.bround(share * BAR_WIDTH).cast("int"))


def _ok(value: str) -> Column:
    return F.when(F.col("status") == OK, F.col(value))


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("status") == OK).alias("n_ok"),
        F.count_if(F.col("status") != OK).alias("n_error"),
    ]


def document_summary(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """One row: counts, metric means over ok rows (6 places) and latency mean and median (3 places)."""
    means = [F.bround(F.avg(_ok(m)), 6).alias(f"{m}_mean") for m in metrics]
    latency = F.bround(F.avg(_ok("latency_s")), 3).alias("latency_mean_s")
    median = exact_median(results.filter(F.col("status") == OK).select("latency_s"), "latency_s")
    row = results.agg(*_counts(), *means, latency)
    return row.withColumn("latency_median_s", F.bround(median.scalar(), 3))


def metric_means(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """One row of unrounded means over ok rows, 0.0 where there is no value."""
    return results.agg(*[F.coalesce(F.avg(_ok(m)), F.lit(0.0)).alias(m) for m in metrics])


def profile_summary(results: DataFrame, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> DataFrame:
    """One row: counts, mean field accuracy and the share of matches per field, over ok rows (6 places)."""
    shares = [
        F.bround(F.avg(F.when(F.col("status") == OK, F.col(f"field_{f.name}").cast("double"))), 6).alias(f"field_{f.name}_accuracy") for f in fields
    ]
    return results.agg(*_counts(), F.bround(F.avg(_ok("field_accuracy")), 6).alias("field_accuracy_mean"), *shares)


def field_table(summary: DataFrame, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> DataFrame:
    """The per-field shares of a `profile_summary` row as rows (`field`, `accuracy`, `bar`)."""
    items = [F.struct(F.lit(f.name).alias("field"), F.col(f"field_{f.name}_accuracy").alias("accuracy")) for f in fields]
    rows = summary.select(F.explode(F.array(*items)).alias("x")).select("x.field", "x.accuracy")
    return rows.filter(F.col("accuracy").isNotNull()).withColumn("bar", accuracy_bar(F.col("accuracy")))


def document_scores(results: DataFrame, metric: str = PRIMARY_METRIC) -> DataFrame:
    """Mean score per document over ok rows, worst first, with a short label and a band."""
    means = results.filter(F.col("status") == OK).groupBy("doc").agg(F.avg(metric).alias("score"))
    return means.select("doc", truncate(F.col("doc")).alias("label"), "score", band(F.col("score")).alias("band")).orderBy("score", "doc")


def _filled(counts: DataFrame, bins: int) -> DataFrame:
    """All bins from 1 on, those without rows counted as 0."""
    spark = counts.sparkSession
    every = spark.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def _binned(values: DataFrame, value: str, lo: Column, hi: Column, bins: int) -> DataFrame:
    """Rows per bin; bins are closed on the left, the last one on both sides."""
    place = F.floor((F.col(value) - lo) / (hi - lo) * bins) + 1
    inside = values.filter((F.col(value) >= lo) & (F.col(value) <= hi))
    return _filled(inside.groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")), bins)


def score_histogram(results: DataFrame, metric: str = PRIMARY_METRIC, bins: int = SCORE_BINS) -> DataFrame:
    """Counts of ok rows in equal bins of [0, 1]."""
    return _binned(results.filter(F.col("status") == OK), metric, F.lit(0.0), F.lit(1.0), bins)


def latency_histogram(results: DataFrame, bins: int = LATENCY_BINS) -> DataFrame:
    """Counts of ok rows in equal bins from the smallest to the largest latency.

    If all values are equal, the bins span half a unit to both sides.
    """
    rows = results.filter((F.col("status") == OK) & F.col("latency_s").isNotNull()).select("latency_s")
    ends = rows.agg(F.min("latency_s").alias("lo"), F.max("latency_s").alias("hi"))
    pad = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    lo = ends.select((F.col("lo") - pad).alias("lo")).scalar()
    hi = ends.select((F.col("hi") + pad).alias("hi")).scalar()
    return _binned(rows, "latency_s", lo, hi, bins)


def first_error(results: DataFrame, key: str = "sample", reply_chars: int = 120) -> DataFrame:
    """One row: the status of the first failed request, and the start of the first unreadable reply.

    First by timestamp, then by `key`. Null where there is none.
    """
    kind = status_class(F.col("status"))
    at = F.struct("timestamp", key)
    reply = F.substring("raw_response", 1, reply_chars) if "raw_response" in results.columns else F.lit(None).cast("string")
    return results.agg(
        F.min_by("status", F.when(kind == ERROR, at)).alias("first_error"),
        F.min_by(reply, F.when(kind == PARSE_ERROR, at)).alias("first_unreadable"),
    )
