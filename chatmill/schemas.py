"""Row shapes shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("text", T.StringType()),
        # The whole part as JSON text, where it has other keys than these.
        T.StructField("json", T.StringType()),
    ]
)

# A turn's content is either plain text (`content`) or a list of parts (`parts`); the other one is null.
TURN = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("parts", T.ArrayType(PART)),
    ]
)

CONVERSATION = T.StructType([T.StructField("conversations", T.ArrayType(TURN))])


@dataclass(frozen=True)
class FieldSpec:
    """One field of an extraction target: a string-or-null, a date string, or a list."""

    name: str
    description: str
    is_list: bool = False
    is_date: bool = False


# The extraction target's field names, their order and their kinds.
# `{date}` is replaced by the label of the date format a prompt asks for.
PROFILE_FIELDS: tuple[FieldSpec, ...] = (
    FieldSpec("name", "what the person is called, first and last name (text)"),
    FieldSpec("gender", '"male" or "female", if the text tells (text)'),
    FieldSpec("email", "where mail reaches the person (text)"),
    FieldSpec("address", "street and town that the person lives in now (text)"),
    FieldSpec("date_of_birth", "day of birth, written {date} (text)", is_date=True),
    FieldSpec("nationality", "citizenship (text)"),
    FieldSpec("languages", "each language with how well it is spoken (list of texts)", is_list=True),
    FieldSpec("education", "schools, degrees and courses, one entry each (list of texts)", is_list=True),
    FieldSpec("skills", "what the person knows how to do at work (list of texts)", is_list=True),
    FieldSpec("products", "programs, machines and other named goods worked with (list of texts)", is_list=True),
)

# The text metrics kept per scored reply, and the one used for ranking documents.
METRICS = ("exact_match", "token_f1", "rouge1_f", "rouge2_f", "rougeL_f", "edit_sim")
PRIMARY_METRIC = "rougeL_f"

DOC_RESULT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("doc", "question", "ground_truth", "raw_response", "response")]
    + [T.StructField(n, T.DoubleType()) for n in (*METRICS, "latency_s")]
    + [T.StructField("status", T.StringType()), T.StructField("timestamp", T.TimestampType())]
)


def profile_result(fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> T.StructType:
    """Row of the structured-extraction result log."""
    return T.StructType(
        [T.StructField("sample", T.StringType()), T.StructField("raw_response", T.StringType())]
        + [T.StructField(f"field_{f.name}", T.BooleanType()) for f in fields]
        + [
            T.StructField("fields_matched", T.IntegerType()),
            T.StructField("fields_total", T.IntegerType()),
            T.StructField("field_accuracy", T.DoubleType()),
            T.StructField("latency_s", T.DoubleType()),
            T.StructField("status", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    )


SCALARS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

LOG_ENTRY = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("global_step", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("eval_loss", T.DoubleType()),
        T.StructField("grad_norm", T.DoubleType()),
        T.StructField("learning_rate", T.DoubleType()),
    ]
)
