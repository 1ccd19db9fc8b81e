"""Tasks to scored result rows and their summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.prompts import schema_prompt
from chatmill.operators.infer import InferSettings, ask_model, evaluate_documents, evaluate_profiles
from chatmill.operators.report import document_summary, profile_summary
from chatmill.plans.profiles import conversation_tasks, folder_tasks
from chatmill.schemas import DOC_RESULT, PROFILE_FIELDS, FieldSpec, profile_result
from chatmill.sources.folders import read_sample_folders
from chatmill.sources.files import path_exists
from chatmill.sources.journal import Journal
from chatmill.sources.jsonl import read_conversations
from chatmill.sources.logs import has_summary, read_results
from chatmill.sources.sinks import append_results, append_summary


def task_key(*columns: str) -> Column:
    """One text for the columns that tell tasks apart; a null is a value of its own."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def settled(results: DataFrame, key: list[str]) -> DataFrame:
    """Result rows without those of failed requests whose task was answered later on."""
    keyed = results.withColumn("__task", task_key(*key))
    failed = F.col("status").startswith("error")
    answered = keyed.filter(~failed).select("__task").distinct()
    return keyed.filter(~failed).unionByName(keyed.filter(failed).join(answered, "__task", "left_anti")).drop("__task")


def _run_rest(
    tasks: DataFrame, key: list[str], log: str, schema: T.StructType, ask: Callable[[DataFrame, str], DataFrame], score: Callable[[DataFrame], DataFrame], summary: Callable[[DataFrame], DataFrame],
    retry_failed: bool,
) -> DataFrame:
    """Ask for the tasks without a reply, append to the log what it lacks, then the summary if anything was new; returns the summary.

    Replies are kept in the journal `<log>_journal` while they come in, so a run that dies loses what was under way and a few seconds more.
    Equal tasks are asked once and logged as often as they occur. Asking and logging read the tasks once each.
    """
    spark = tasks.sparkSession
    journal = Journal(spark, f"{log.rstrip('/')}_journal")
    keyed = tasks.withColumn("__task", task_key(*key))
    known = journal.replies()
    if path_exists(spark, log):
        logged = read_results(spark, log, schema).select(task_key(*key).alias("task"), "status")
    else:
        logged = known.select("task", "status").limit(0)
    done = known.select("task", "status").unionByName(logged)
    if retry_failed:
        done = done.filter(~F.col("status").startswith("error"))
    rest = keyed.join(done.select(F.col("task").alias("__task")).distinct(), "__task", "left_anti").dropDuplicates(["__task"])
    ask(rest, journal.new_run()).write.format("noop").mode("overwrite").save()
    journal.compact()

    failed = F.col("status").startswith("error")
    in_log = logged.groupBy("task").agg(F.bool_or(~failed).alias("answered"))
    replies = journal.replies().join(in_log, "task", "left").filter(F.col("answered").isNull() | (~F.col("answered") & ~failed)).drop("answered")
    seen = Observation()
    new = score(keyed.join(replies.withColumnRenamed("task", "__task"), "__task")).select(*schema.fieldNames())
    append_results(new.observe(seen, F.count(F.lit(1)).alias("n")), log)
    results = settled(read_results(spark, log, schema), key)
    if seen.get["n"] or not has_summary(spark, log):
        return append_summary(summary(results), log)
    return summary(results)


def evaluate_document_tasks(tasks: DataFrame, client_factory, log: str, settings: InferSettings = InferSettings(), retry_failed: bool = False, flush_s: float = 5.0) -> DataFrame:
    """Ask, score and append to the log what it lacks, then its summary; returns the summary. Tasks are told apart by document, question and answer.

    A failed request counts as done unless `retry_failed`; then its task is asked again, and an answer takes the place of the failure in the summary.
    """

    def ask(rest: DataFrame, journal: str) -> DataFrame:
        return ask_model(rest, client_factory, settings, journal=journal, key="__task", flush_s=flush_s)

    return _run_rest(tasks, ["doc", "question", "ground_truth"], log, DOC_RESULT, ask, evaluate_documents, document_summary, retry_failed)


def evaluate_profile_tasks(
    tasks: DataFrame, client_factory, log: str, settings: InferSettings = InferSettings(), fields: tuple[FieldSpec, ...] = PROFILE_FIELDS, retry_failed: bool = False, flush_s: float = 5.0
) -> DataFrame:
    """Ask, score field by field and append to the log what it lacks, then its summary; returns the summary. Tasks are told apart by sample."""

    def ask(rest: DataFrame, journal: str) -> DataFrame:
        prompted = rest.withColumn("system", schema_prompt([f.name for f in fields], 0, fields))
        return ask_model(prompted, client_factory, settings, journal=journal, key="__task", flush_s=flush_s)

    return _run_rest(tasks, ["sample"], log, profile_result(fields), ask, lambda r: evaluate_profiles(r, fields), lambda r: profile_summary(r, fields), retry_failed)


def profile_tasks(spark: SparkSession, folder: str | None = None, records: str | None = None, max_samples: int | None = None) -> DataFrame:
    """Tasks from a folder tree or from prepared records, exactly one of which must be given."""
    if (folder is None) == (records is None):
        raise ValueError("give either a folder or prepared records")
    if folder is not None:
        return folder_tasks(read_sample_folders(spark, folder)[0], max_samples).select("sample", "question", "ground_truth")
    return conversation_tasks(read_conversations(spark, records), max_samples)
