"""Folders of application texts and target objects to conversation records and to evaluation tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.chat import exchange
from chatmill.functions.prompts import SchemaWording, schema_prompt
from chatmill.functions.targets import outline, read_targets, readable, target_faults, with_ordered_target
from chatmill.operators.augment import with_variants
from chatmill.operators.ordering import first_rows, number_samples, seeded_shuffle
from chatmill.operators.split import EVAL, TRAIN, with_split
from chatmill.schemas import PROFILE_FIELDS, FieldSpec
from chatmill.sources.sinks import write_dataset

ROW_ID = ["lang", "sample", "variant"]


def valid_samples(pairs: DataFrame, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(pairs whose target has exactly the expected fields, rejects with their `faults`)."""
    checked = pairs.withColumn("__outline", outline(F.col("json_text")))
    checked = checked.withColumn("faults", target_faults(F.col("__outline"), fields)).drop("__outline")
    return checked.filter(F.size("faults") == 0).drop("faults"), checked.filter(F.size("faults") > 0)


def variant_records(
    samples: DataFrame,
    extra: Column | int = 0,
    seed: int = 42,
    fields: tuple[FieldSpec, ...] = PROFILE_FIELDS,
    wording: SchemaWording = SchemaWording(),
) -> DataFrame:
    """One record per sample and variant: prompt and target follow the variant's field order and notation."""
    # Samples of equal name in two languages are samples of their own.
    name = F.when(F.col("lang") != "", F.concat_ws("/", "lang", "sample")).otherwise(F.col("sample").cast("string"))
    rows = with_variants(read_targets(samples, "json_text", fields), name, extra, seed, fields)
    rows = with_ordered_target(rows, "json_text", F.col("field_order"), F.col("date_fmt"), "target", fields)
    prompt = schema_prompt(F.col("field_order"), F.col("date_fmt"), fields, wording)
    keep = [c for c in samples.columns if c not in ("cv_text", "json_text")]
    return rows.select(*keep, "variant", exchange(prompt, F.col("cv_text"), F.col("target")).alias("conversations"))


def profile_dataset(
    pairs: DataFrame, share: float | None = None, augment: int = 0, seed: int = 42, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS
) -> tuple[DataFrame, DataFrame | None]:
    """(train, eval) records. The split counts pairs before validation; only train gets extra variants and is shuffled."""
    if share is None:
        records = variant_records(valid_samples(pairs, fields)[0], augment, seed, fields)
        return records.repartitionByRange(*ROW_ID).sortWithinPartitions(*ROW_ID), None
    labelled = with_split(pairs, F.concat_ws("/", "lang", "sample"), share, seed)
    good, _ = valid_samples(labelled, fields)
    records = variant_records(good, F.when(F.col("split") == TRAIN, augment).otherwise(0), seed, fields)
    train, evaluation = (records.filter(F.col("split") == side).drop("split") for side in (TRAIN, EVAL))
    return seeded_shuffle(train, seed, ROW_ID), evaluation.repartitionByRange(*ROW_ID).sortWithinPartitions(*ROW_ID)


def profile_rejects(pairs: DataFrame, rejects: DataFrame | None = None, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> DataFrame:
    """What the job leaves out: (`lang`, `sample`, `field`, `fault`), a row for each fault of a target, and for each folder without one of its files."""
    bad = valid_samples(pairs, fields)[1].select("lang", "sample", F.explode("faults").alias("f")).select("lang", "sample", "f.field", "f.fault")
    return bad if rejects is None else bad.unionByName(rejects.select("lang", "sample", F.lit(None).cast("string").alias("field"), "fault"))


def prepare_profiles(
    pairs: DataFrame, path: str, share: float | None = None, augment: int = 0, seed: int = 42, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS, dry: bool = False
) -> DataFrame:
    """The whole job: records of both sides written as JSON lines, or only counted in a `dry` run; (`side`, `path`, `records`)."""
    return write_dataset(*profile_dataset(pairs, share, augment, seed, fields), path, dry)


def folder_tasks(pairs: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Evaluation tasks from sample folders: any readable target counts, its fields are not checked."""
    tasks = pairs.filter(readable(F.col("json_text")))
    return first_rows(tasks.select("lang", "sample", F.col("cv_text").alias("question"), F.col("json_text").alias("ground_truth")), ["lang", "sample"], max_samples)


def conversation_tasks(records: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Evaluation tasks from prepared records (`file`, `seq`, `conversations`), named `sample_<n>` in file order.

    The last user and the last assistant turn count; a target that is no JSON becomes `{}`.
    """

    def last(role: str, default: str) -> Column:
        said = F.filter("conversations", lambda t: t["role"] == role)
        return F.when(F.size(said) > 0, F.element_at(said, -1)["content"]).otherwise(F.lit(default))

    truth = last("assistant", "{}")
    tasks = records.select("file", "seq", last("user", "").alias("question"), truth.alias("ground_truth"))
    tasks = tasks.withColumn("ground_truth", F.when(readable(F.col("ground_truth")), F.col("ground_truth")).otherwise("{}"))
    named = number_samples(first_rows(tasks, ["file", "seq"], max_samples), ["file", "seq"])
    return named.select("sample", "question", "ground_truth")
