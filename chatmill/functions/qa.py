"""Question-and-answer text: blocks split by `--` lines, each a `> question` line and an answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.options import expand_questions
from chatmill.functions.text import LINE_END, SPACE, let, rstrip

# The separator line and the question prefix of the format.
SEPARATOR = rf"(?mdU)^--[{SPACE}]*$"
QUESTION_PREFIX = "> "

NO_PREFIX = "no question prefix"
NO_ANSWER = "no answer"


def _tidy_block(block: Column) -> Column:
    """Lines without trailing white space, outer blank lines gone."""
    lines = F.transform(F.split(block, LINE_END, -1), rstrip)
    return F.regexp_replace(F.array_join(lines, "\n"), r"\A\n++|(?<!\n)\n++\z", "")


def _read_block(block: Column) -> Column:
    head = F.substring_index(block, "\n", 1)
    answer = F.regexp_replace(F.substring(block, F.length(head) + 1, F.length(block)), r"\A\n++", "")
    fault = F.when(~head.startswith(QUESTION_PREFIX), NO_PREFIX).when(answer == "", NO_ANSWER)
    question = F.when(head.startswith(QUESTION_PREFIX), F.substring(head, F.lit(len(QUESTION_PREFIX) + 1), F.length(head)))
    return F.struct(question.alias("question"), answer.alias("answer"), head.alias("head"), fault.alias("fault"))


def qa_blocks(text: Column) -> Column:
    """ARRAY<STRUCT<question, answer, head, fault>>: the non-empty blocks of a text, faulty ones included."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    blocks = F.transform(F.split(unix, SEPARATOR, -1), _tidy_block)
    return F.transform(F.filter(blocks, lambda b: b != ""), lambda b: let(b, _read_block))


def parse_qa(df: DataFrame, text: str = "qa_text") -> tuple[DataFrame, DataFrame]:
    """Split a table of Q&A texts into (samples, rejects).

    Samples carry `block_no` (from 0 over the non-empty blocks), `question` and `answer`; rejects carry
    `block_no`, the first line as `head`, and the `fault`. All other columns but the text pass through.
    """
    rows = df.select("*", F.posexplode(qa_blocks(F.col(text))).alias("block_no", "__b")).drop(text)
    keep = [c for c in rows.columns if c != "__b"]
    samples = rows.filter(F.col("__b.fault").isNull()).select(*keep, "__b.question", "__b.answer")
    rejects = rows.filter(F.col("__b.fault").isNotNull()).select(*keep, "__b.head", "__b.fault")
    return samples, rejects


def qa_samples(df: DataFrame, text: str = "qa_text") -> DataFrame:
    """Parsed and expanded samples: one row per question, numbered by (`block_no`, `option_no`)."""
    samples, _ = parse_qa(df, text)
    return expand_questions(samples)
