"""Evaluation logs: summaries, histograms, errors, inference, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.prompts import DOCUMENT_PREAMBLE
from chatmill.operators import report
from chatmill.operators.conversations import last_turns
from chatmill.operators.infer import InferSettings, Request, ask_model, evaluate_documents, join_replies
from chatmill.operators.staging import new_path, stage
from chatmill.queries.registry import Tables, query
from chatmill.sources.files import put_new
from chatmill.sources.journal import Journal
from chatmill.sources.snapshots import publish, read_current
from chatmill.streaming.results import append_scored, read_stream, rolling_summary

# A result log made from the events; valid in Spark and in DuckDB.
LOG_COLUMNS = {
    "sample": "event_id",
    "doc": "'evaluation document made for user with number ' || CAST(user_id AS STRING)",
    "rougeL_f": "value / (value + 50.0)",
    "exact_match": "CASE WHEN value > 40 THEN 1.0 ELSE 0.0 END",
    "latency_s": "CASE WHEN event_id % 11 = 5 THEN NULL ELSE value END",
    "status": "CASE event_id % 20 WHEN 3 THEN 'error: timeout of ' || event_type WHEN 7 THEN 'parse_error' ELSE 'ok' END",
    "raw_response": "repeat(event_type || ' ', 30)",
}
LOG_SQL = "WITH log AS (SELECT ts AS timestamp, event_type, " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" if k in ("rougeL_f", "exact_match") else f"{v} AS {k}" for k, v in LOG_COLUMNS.items()) + " FROM events)\n"
METRICS = ("rougeL_f", "exact_match")


def _shape(events: DataFrame) -> DataFrame:
    columns = [F.expr(f"CAST({v} AS DOUBLE)" if k in METRICS else v).alias(k) for k, v in LOG_COLUMNS.items()]
    return events.select(F.col("ts").alias("timestamp"), "event_type", *columns)


def _log(t: Tables) -> DataFrame:
    return _shape(t.events)


@query(
    LOG_SQL
    + """SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'ok') AS n_ok, count(*) FILTER (WHERE status <> 'ok') AS n_error,
  round_even(avg(rougeL_f) FILTER (WHERE status = 'ok'), 6) AS rougeL_f_mean, round_even(avg(exact_match) FILTER (WHERE status = 'ok'), 6) AS exact_match_mean,
  round_even(avg(latency_s) FILTER (WHERE status = 'ok'), 3) AS latency_mean_s, round_even(median(latency_s) FILTER (WHERE status = 'ok'), 3) AS latency_median_s
FROM log"""
)
def eval_summary(t: Tables):
    return report.document_summary(_log(t), METRICS)


@query(LOG_SQL + "SELECT round(avg(rougeL_f), 6) AS rougeL_f, round(avg(exact_match), 6) AS exact_match FROM log WHERE status = 'ok'")
def metric_means(t: Tables):
    return report.metric_means(_log(t), METRICS).select(*[F.round(m, 6).alias(m) for m in METRICS])


@query(
    LOG_SQL
    + """SELECT doc, CASE WHEN length(doc) <= 45 THEN doc ELSE left(doc, 44) || '…' END AS label, round(avg(rougeL_f), 6) AS score,
  CASE WHEN avg(rougeL_f) < 0.5 THEN 'low' WHEN avg(rougeL_f) < 0.8 THEN 'middle' ELSE 'high' END AS band
FROM log WHERE status = 'ok' GROUP BY doc"""
)
def doc_scores(t: Tables):
    return report.document_scores(_log(t)).withColumn("score", F.round("score", 6))


@query(
    LOG_SQL
    + """, b AS (SELECT CAST(least(floor(rougeL_f * 25) + 1, 25) AS INTEGER) AS bin, count(*) AS n FROM log WHERE status = 'ok' GROUP BY 1)
SELECT g.bin, coalesce(b.n, 0) AS n FROM (SELECT CAST(unnest(range(1, 26)) AS INTEGER) AS bin) g LEFT JOIN b ON b.bin = g.bin"""
)
def score_hist(t: Tables):
    return report.score_histogram(_log(t))


@query(
    LOG_SQL
    + """, e AS (SELECT min(latency_s) AS lo, max(latency_s) AS hi FROM log WHERE status = 'ok'),
b AS (SELECT CAST(least(floor((latency_s - lo) / (hi - lo) * 30) + 1, 30) AS INTEGER) AS bin, count(*) AS n FROM log, e WHERE status = 'ok' AND latency_s IS NOT NULL GROUP BY 1)
SELECT g.bin, coalesce(b.n, 0) AS n FROM (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS bin) g LEFT JOIN b ON b.bin = g.bin"""
)
def latency_hist(t: Tables):
    return report.latency_histogram(_log(t))


@query(
    LOG_SQL
    + """SELECT CASE WHEN status IN ('ok', 'parse_error') THEN status ELSE 'error' END AS status, count(*) AS n,
  count(*) FILTER (WHERE rougeL_f < 0.5) AS low, count(*) FILTER (WHERE rougeL_f >= 0.8) AS high FROM log GROUP BY 1"""
)
def status_bands(t: Tables):
    score = report.band(F.col("rougeL_f"))
    rows = _log(t).groupBy(report.status_class(F.col("status")).alias("status"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(score == "low").alias("low"), F.count_if(score == "high").alias("high"))


@query(
    LOG_SQL
    + """SELECT (SELECT status FROM log WHERE status NOT IN ('ok', 'parse_error') ORDER BY timestamp, sample LIMIT 1) AS first_error,
  (SELECT left(raw_response, 120) FROM log WHERE status = 'parse_error' ORDER BY timestamp, sample LIMIT 1) AS first_unreadable"""
)
def first_error(t: Tables):
    return report.first_error(_log(t))


class EchoClient:
    """Stands in for a model: fails for some questions, has no reply for others, else repeats the question."""

    def __call__(self, request: Request) -> str | None:
        size = len(request.user)
        if size % 7 == 0:
            raise ConnectionError("no answer")
        return None if size % 7 == 1 else f"<think>{request.seed}</think>{request.user}"


def _replies(t: Tables) -> DataFrame:
    tasks = last_turns(t.conversations).withColumn("system", F.lit(DOCUMENT_PREAMBLE))
    return ask_model(tasks, EchoClient, InferSettings(retries=2), pause=lambda _: 0.0, clock=lambda: 0.0)


INFER_SQL = """
WITH q AS (SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS question,
                  coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '{}') AS ground_truth FROM conversations GROUP BY conv_id)
"""


@query(
    INFER_SQL
    + """SELECT conv_id,
  CASE length(question) % 7 WHEN 0 THEN '' WHEN 1 THEN '' ELSE '<think>42</think>' || question END AS raw_response,
  CASE WHEN length(question) % 7 = 0 THEN 'error: Request failed after 2 attempts: no answer' ELSE 'ok' END AS status,
  CASE WHEN length(question) % 7 = 0 THEN NULL ELSE 0.0 END::DOUBLE AS latency_s FROM q"""
)
def batch_infer(t: Tables):
    return _replies(t).select("conv_id", "raw_response", "status", "latency_s")


@query(
    INFER_SQL
    + """SELECT conv_id, CASE WHEN length(question) % 7 IN (0, 1) THEN '' ELSE trim(question, ' ' || chr(9) || chr(10) || chr(13)) END AS response,
  CASE length(question) % 7 WHEN 0 THEN NULL WHEN 1 THEN 0.0
    ELSE CASE WHEN trim(regexp_replace(lower(question), '\\s+', ' ', 'g')) = trim(regexp_replace(lower(ground_truth), '\\s+', ' ', 'g')) THEN 1.0 ELSE 0.0 END END::DOUBLE AS exact_match
FROM q"""
)
def infer_scored(t: Tables):
    """Replies scored as document results; failed requests keep null metrics."""
    return evaluate_documents(_replies(t)).select("conv_id", "response", "exact_match")


@query(INFER_SQL + "SELECT conv_id, length(question) % 7 = 0 AS open FROM q")
def unanswered_tasks(t: Tables):
    tasks = last_turns(t.conversations)
    answered = stage(_replies(t).filter(F.col("status") == "ok").select("conv_id", "raw_response"), "replies")
    done, left = join_replies(tasks.select("conv_id"), answered, "conv_id")
    return done.select("conv_id", F.lit(False).alias("open")).unionByName(left.select("conv_id", F.lit(True).alias("open")))


class DownClient:
    """A service that answers nothing."""

    def __call__(self, request: Request) -> str | None:
        raise ConnectionError("down")


@query(
    INFER_SQL
    + """SELECT conv_id,
  CASE length(question) % 7 WHEN 0 THEN '' WHEN 1 THEN '' ELSE '<think>42</think>' || question END AS raw_response,
  CASE WHEN length(question) % 7 = 0 THEN 'error: Request failed after 1 attempts: down' ELSE 'ok' END AS status FROM q"""
)
def reply_journal(t: Tables):
    """Replies read back from a journal that a run left half-way, a crash cut off in a line, and a run against a dead service came after.

    The first run asks for some tasks, and is folded into the base; the second asks for what has no answer; the third asks for all again
    and is answered nothing, which takes no answer away.
    """
    journal = Journal(t.spark, new_path(t.spark, "journal"))
    tasks = last_turns(t.conversations).select("conv_id", "question", F.lit("").alias("system"), F.col("conv_id").cast("string").alias("task"))

    def ask(some: DataFrame, client: type) -> str:
        run = journal.new_run()
        ask_model(some, client, InferSettings(retries=1), journal=run).write.format("noop").mode("overwrite").save()
        return run

    first = ask(tasks.filter(F.pmod(F.xxhash64("task"), F.lit(3)) == 0), EchoClient)
    put_new(t.spark, f"{first}/cut-0.jsonl", '{"task": "1", "status": "ok", "raw_resp')
    journal.compact()
    answered = journal.replies().filter("status = 'ok'").select("task")
    ask(tasks.join(answered, "task", "left_anti"), EchoClient)
    ask(tasks, DownClient)
    return tasks.select("conv_id", "task").join(journal.replies(), "task").select("conv_id", "raw_response", "status")


@query(
    LOG_SQL
    + """SELECT doc, round(avg(rougeL_f), 6) AS score, count(*) AS n FROM log WHERE status = 'ok' GROUP BY doc"""
)
def panel_versions(t: Tables):
    """A table published again as more rows arrive, read as the current version; a writer that died has left a version nobody points to."""
    folder = new_path(t.spark, "panels")

    def scores(log: DataFrame) -> DataFrame:
        return log.filter("status = 'ok'").groupBy("doc").agg(F.round(F.avg("rougeL_f"), 6).alias("score"), F.count(F.lit(1)).alias("n"))

    for share in (3, 2, 1):
        number = publish(scores(_log(t).filter(F.col("sample") % share == 0)), folder, keep=2)
        scores(_log(t).limit(1)).write.parquet(f"{folder}/v={number + 1}")
    return read_current(t.spark, folder)


def _event_stream(t: Tables) -> DataFrame:
    return _shape(read_stream(t.spark, t.folder, t.events.schema, "parquet", glob="events.parquet"))


def _score(rows: DataFrame) -> DataFrame:
    return rows.select("sample", "doc", "rougeL_f", "status", report.band(F.col("rougeL_f")).alias("band"))


@query(
    LOG_SQL
    + """SELECT sample, doc, round(rougeL_f, 6) AS rougeL_f, status,
  CASE WHEN rougeL_f < 0.5 THEN 'low' WHEN rougeL_f < 0.8 THEN 'middle' ELSE 'high' END AS band FROM log"""
)
def stream_scores(t: Tables):
    """Events arriving as a stream, scored and appended; the appended table is the result."""
    out = new_path(t.spark, "stream-scores")
    append_scored(_event_stream(t), _score, out, f"{out}-checkpoint").awaitTermination()
    return t.spark.read.parquet(out).withColumn("rougeL_f", F.round("rougeL_f", 6))


@query(
    LOG_SQL
    + """SELECT event_type, count(*) AS n_total, count(*) FILTER (WHERE status = 'ok') AS n_ok,
  round(avg(rougeL_f) FILTER (WHERE status = 'ok'), 6) AS rougeL_f_mean FROM log GROUP BY event_type"""
)
def stream_summary(t: Tables):
    out = new_path(t.spark, "stream-summary")
    rolling_summary(_event_stream(t), ["event_type"], ("rougeL_f",), out, f"{out}-checkpoint").awaitTermination()
    return read_current(t.spark, out).withColumn("rougeL_f_mean", F.round("rougeL_f_mean", 6))
