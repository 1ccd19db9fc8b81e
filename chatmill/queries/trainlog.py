"""Training logs made from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.operators import trainlog
from chatmill.operators.staging import new_path
from chatmill.queries.registry import Tables, query
from chatmill.schemas import SCALARS
from chatmill.sources.logs import read_log_lines
from chatmill.streaming.monitor import TrainingMonitor
from chatmill.streaming.results import read_stream

# Scalar rows made from the events; valid in Spark and in DuckDB.
TAG_SQL = """CASE event_type WHEN 'click' THEN 'train/loss' WHEN 'view' THEN 'eval_loss' WHEN 'signup' THEN 'train/learning_rate'
  WHEN 'purchase' THEN 'train/grad_norm' ELSE 'train/epoch' END"""
SCALAR_COLUMNS = {
    "file": "'events.' || CAST(user_id % 3 AS STRING)",
    "tag": TAG_SQL,
    "step": "event_id - event_id % 7",
    "value": "value / 20.0",
    "seq": "event_id",
}
SCALAR_SQL = "WITH s AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in SCALAR_COLUMNS.items()) + " FROM events)"
SERIES_SQL = SCALAR_SQL + ", series AS (SELECT tag, step, arg_max(value, (file, seq)) AS value FROM s GROUP BY tag, step)\n"


def _scalars(t: Tables) -> DataFrame:
    return t.events.select(*[F.expr(v).alias(k) for k, v in SCALAR_COLUMNS.items()])


def _series(t: Tables) -> DataFrame:
    return trainlog.dedup_series(_scalars(t))


@query(SERIES_SQL + "SELECT tag, step, value FROM series")
def series_dedup(t: Tables):
    return _series(t)


@query(SERIES_SQL + "SELECT tag, step, value FROM series")
def scalar_files(t: Tables):
    """The events written as log files, one of which a crash cut off in a line, and read back with all runs merged."""
    folder = new_path(t.spark, "scalars")
    rows = _scalars(t).repartitionByRange("seq").sortWithinPartitions("seq")
    # Rows carry their file and place, so the order of part files on disk doesn't matter.
    rows.select(F.to_json(F.struct("file", "tag", "step", "value", F.col("seq").alias("place"))).alias("value")).write.text(f"{folder}/whole")
    t.events.limit(1).select(F.lit('{"file": "events.9", "tag": "eval_loss", "st').alias("value")).write.text(f"{folder}/cut")
    lines = read_log_lines(t.spark.read.option("recursiveFileLookup", True).text(folder), T.StructType([*SCALARS.fields, T.StructField("place", T.LongType())]))
    return trainlog.dedup_series(lines, order=("file", "place"))


@query(SCALAR_SQL + "SELECT tag, step, arg_max(value, seq) AS value FROM s WHERE file = (SELECT max(file) FROM s) GROUP BY tag, step")
def series_latest_file(t: Tables):
    return trainlog.dedup_series(trainlog.latest_file(_scalars(t)))


@query(SERIES_SQL + "SELECT tag, count(*) AS points, max(step) AS last_step, arg_max(value, step) AS last_value FROM series GROUP BY tag")
def tag_inventory(t: Tables):
    return trainlog.tag_inventory(_series(t))


@query(SERIES_SQL + "SELECT tag, step, value FROM series WHERE tag = 'eval_loss'")
def tag_fallback(t: Tables):
    """`eval/loss` does not occur in the data, so the second candidate is taken."""
    return trainlog.pick_series(_series(t), trainlog.PANEL_TAGS["eval_loss"])


@query(SERIES_SQL + "SELECT coalesce(max(step), 0) AS max_step FROM series WHERE tag IN ('train/loss', 'eval/loss', 'eval_loss')")
def horizon(t: Tables):
    return trainlog.run_horizon(_series(t))


@query(
    SERIES_SQL
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY value, step) AS lo, row_number() OVER (PARTITION BY tag ORDER BY value DESC, step) AS hi FROM series)
SELECT tag, CASE WHEN lo = 1 THEN 'min' ELSE 'max' END AS direction, step AS best_step, value AS best_value FROM r WHERE lo = 1 OR hi = 1"""
)
def best_step(t: Tables):
    low = trainlog.best_point(_series(t), "tag").withColumn("direction", F.lit("min"))
    return low.unionByName(trainlog.best_point(_series(t), "tag", greater_is_better=True).withColumn("direction", F.lit("max")))


# Smoothed values of few points are short decimals, and may end in a 5 just behind the last place shown: a little more than nothing is added on both sides, so
# that the order in which two engines add does not decide how these are rounded.
NUDGE = 3.3e-11

EMA_SQL = """
WITH RECURSIVE n AS (SELECT tag, step, value, row_number() OVER (PARTITION BY tag ORDER BY step) AS rn FROM (
    SELECT {tag} AS tag, event_id - event_id % 7 AS step, arg_max(value / 20.0, ('events.' || (user_id % 3), event_id)) AS value FROM events GROUP BY 1, 2)),
e AS (SELECT tag, step, value, rn, value AS ema FROM n WHERE rn = 1
  UNION ALL SELECT n.tag, n.step, n.value, n.rn, {alpha} * n.value + (1 - {alpha}) * e.ema FROM e JOIN n ON n.tag = e.tag AND n.rn = e.rn + 1)
"""


@query(
    EMA_SQL.format(tag=TAG_SQL, alpha="CAST(0.1 AS DOUBLE)")
    + f"""SELECT tag, step, round(ema + {NUDGE}, 6) AS ema, round(exp(least(value, 20)) / 1000, 6) AS perplexity_k, round(exp(least(ema, 20)), 4) AS perplexity_ema FROM e"""
)
def ema_perplexity(t: Tables):
    panel = trainlog.loss_panel(_series(t))
    return panel.select(
        "tag", "step", F.round(F.col("ema") + NUDGE, 6).alias("ema"), F.round(F.col("perplexity") / 1000, 6).alias("perplexity_k"), F.round("perplexity_ema", 4).alias("perplexity_ema")
    )


@query(EMA_SQL.format(tag=TAG_SQL, alpha="CAST(0.2 AS DOUBLE)") + f"SELECT step, round(ema + {NUDGE}, 6) AS ema FROM e WHERE tag = 'train/grad_norm'")
def ema_grad_norm(t: Tables):
    norm = trainlog.pick_series(_series(t), trainlog.PANEL_TAGS["grad_norm"])
    return trainlog.ema(norm, alpha=trainlog.GRAD_NORM_ALPHA).select("step", F.round(F.col("ema") + NUDGE, 6).alias("ema"))


# Sparse log entries of two overlapping runs; valid in Spark and in DuckDB.
ENTRY_COLUMNS = {
    "step": "CASE WHEN event_id % 10 = 0 THEN 0 WHEN event_id % 10 = 5 THEN NULL ELSE event_id - event_id % 4 END",
    "global_step": "CASE WHEN event_id % 30 = 0 THEN NULL ELSE event_id - event_id % 4 END",
    "loss": "CASE WHEN event_type <> 'error' THEN value END",
    "eval_loss": "CASE WHEN event_type = 'error' THEN value END",
    "grad_norm": "CASE WHEN event_type IN ('purchase', 'error') THEN value * 2 END",
    "learning_rate": "CASE WHEN event_type = 'click' THEN value / 4 END",
}
ENTRY_SQL = (
    "WITH x AS (SELECT user_id, " + ", ".join(f"{v} AS {k}" for k, v in ENTRY_COLUMNS.items()) + " FROM events),\n"
    "a AS (SELECT *, coalesce(nullif(step, 0), global_step, 0) AS at_step FROM x),\n"
    "m AS (SELECT * FROM a WHERE user_id % 3 = 1 UNION ALL SELECT * FROM a WHERE user_id % 3 <> 1 AND at_step NOT IN (SELECT at_step FROM a WHERE user_id % 3 = 1))\n"
)


def _runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    entries = t.events.select("user_id", *[F.expr(v).cast("bigint" if "step" in k else "double").alias(k) for k, v in ENTRY_COLUMNS.items()])
    return entries.filter(F.col("user_id") % 3 != 1).drop("user_id"), entries.filter(F.col("user_id") % 3 == 1).drop("user_id")


def _merged(t: Tables) -> DataFrame:
    return trainlog.merge_history(*_runs(t))


@query(ENTRY_SQL + "SELECT at_step, loss, eval_loss, grad_norm, learning_rate FROM m")
def merge_history(t: Tables):
    return _merged(t).select("at_step", "loss", "eval_loss", "grad_norm", "learning_rate")


@query(
    ENTRY_SQL
    + """SELECT 'train_loss' AS tag, at_step AS step, loss AS value FROM m WHERE loss IS NOT NULL
UNION ALL SELECT 'eval_loss', at_step, eval_loss FROM m WHERE eval_loss IS NOT NULL
UNION ALL SELECT 'grad_norm', at_step, grad_norm FROM m WHERE loss IS NOT NULL AND grad_norm IS NOT NULL
UNION ALL SELECT 'learning_rate', at_step, learning_rate FROM m WHERE loss IS NOT NULL AND learning_rate IS NOT NULL"""
)
def entry_series(t: Tables):
    return trainlog.entry_series(_merged(t))


@query(
    ENTRY_SQL.replace("WITH x", "WITH RECURSIVE x").rstrip()
    + """,
p AS (SELECT 'train_loss' AS tag, at_step AS step, loss AS value, CAST(0.1 AS DOUBLE) AS alpha FROM m WHERE loss IS NOT NULL
  UNION ALL SELECT 'eval_loss', at_step, eval_loss, NULL FROM m WHERE eval_loss IS NOT NULL
  UNION ALL SELECT 'grad_norm', at_step, grad_norm, CAST(0.2 AS DOUBLE) FROM m WHERE loss IS NOT NULL AND grad_norm IS NOT NULL
  UNION ALL SELECT 'learning_rate', at_step, learning_rate, NULL FROM m WHERE loss IS NOT NULL AND learning_rate IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY step, value) AS rn FROM p),
e AS (SELECT tag, step, value, alpha, rn, CASE WHEN alpha IS NOT NULL THEN value END AS ema FROM n WHERE rn = 1
  UNION ALL SELECT n.tag, n.step, n.value, n.alpha, n.rn, n.alpha * n.value + (1 - n.alpha) * e.ema FROM e JOIN n ON n.tag = e.tag AND n.rn = e.rn + 1)
SELECT tag, step, value, round(ema + 3.3e-11, 6) AS ema FROM e"""
)
def training_monitor(t: Tables):
    """The events as the entries of a run that goes on from an earlier one, followed as a stream; the panels after its end."""
    prior, current = _runs(t)
    folder = new_path(t.spark, "monitor")
    current.write.parquet(f"{folder}/log")
    monitor = TrainingMonitor(f"{folder}/run", prior)
    monitor.start(read_stream(t.spark, f"{folder}/log", current.schema, "parquet"), f"{folder}/checkpoint").awaitTermination()
    monitor.finish()
    return monitor.panels().select("tag", "step", "value", F.round(F.col("ema") + NUDGE, 6).alias("ema"))


@query("""
WITH c AS (SELECT event_type, event_id, CAST(floor(event_id / 900) AS BIGINT) AS checkpoint FROM events)
SELECT event_type, event_id, checkpoint FROM c JOIN (SELECT event_type, max(checkpoint) AS checkpoint FROM c GROUP BY event_type) USING (event_type, checkpoint)
""")
def latest_checkpoint(t: Tables):
    folder = F.concat(F.lit("out/checkpoint-"), F.floor(F.col("event_id") / 900).cast("string"))
    rows = t.events.select("event_type", "event_id", folder.alias("folder"))
    return trainlog.latest_checkpoint(rows, by="event_type").select("event_type", "event_id", "checkpoint")
