"""Moving between the long turn table and conversation records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.chat import is_multimodal
from chatmill.operators.combine import any_true
from chatmill.schemas import PART


def nest_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One record per conversation with its turns in order. The record is one row by definition."""
    parts = F.col("parts") if "parts" in df.columns else F.lit(None).cast(f"array<{PART.simpleString()}>")
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"), parts.alias("parts"))
    nested = df.groupBy(conv).agg(F.array_sort(F.collect_list(item)).alias("__turns"))
    shaped = F.transform("__turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), t["parts"].alias("parts")))
    return nested.select(conv, shaped.alias("conversations"))


def unnest_turns(df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turn table (`turn` from 0) of conversation records."""
    return df.select(conv, F.posexplode("conversations").alias("turn", "t")).select(
        conv, F.col("turn").cast("bigint").alias("turn"), "t.role", "t.content", "t.parts"
    )


def last_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation the last user text as `question` and the last assistant text as `ground_truth`.

    Absent roles give an empty question and the truth `{}`. Aggregates only, so turns are reduced before the shuffle.
    """

    def last_of(name: str):
        return F.max_by(text, F.when(F.col(role) == name, F.col(turn)))

    return df.groupBy(conv).agg(
        F.coalesce(last_of("user"), F.lit("")).alias("question"),
        F.coalesce(last_of("assistant"), F.lit("{}")).alias("ground_truth"),
    )


def reply_pairs(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each user turn with the assistant turn right after it, as (`question`, `reply`).

    Joined on conversation and turn number together, so a very long conversation is spread by its turns.
    """
    users = df.filter(F.col(role) == "user").select(conv, F.col(turn).alias("turn"), F.col(text).alias("question"))
    replies = df.filter(F.col(role) == "assistant").select(conv, (F.col(turn) - 1).alias("turn"), F.col(text).alias("reply"))
    return users.join(replies, [conv, "turn"])


def multimodal_route(df: DataFrame) -> DataFrame:
    """One row: the way the whole dataset takes, `multimodal` if any turn holds parts, else `text`."""
    found = any_true(df, is_multimodal(F.col("conversations")), "found")
    return found.select(F.when(F.col("found"), "multimodal").otherwise("text").alias("route"))
