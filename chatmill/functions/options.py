"""Question templates with `{a, b}` option blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import let, strip

# An option block is a brace pair around one or more characters other than `}`;
# the option `_` stands for nothing.
OPTION_BLOCK = r"(\{[^}]+\})"
NOTHING = "_"

# Questions numbered at a time.
CHUNK = 10_000
# Tasks for ranges of large products, for each shuffle partition.
SPREAD = 2


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def option_blocks(template: Column) -> Column:
    """ARRAY<STRUCT<block, options>>, in order of appearance."""
    return F.transform(
        F.regexp_extract_all(template, F.lit(OPTION_BLOCK), F.lit(1)),
        lambda b: F.struct(
            b.alias("block"),
            F.transform(F.split(F.substring(b, F.lit(2), F.length(b) - 2), ",", -1), strip).alias("options"),
        ),
    )


def option_count(blocks: Column) -> Column:
    """Number of questions a template stands for: the product of its block sizes."""
    return F.aggregate(blocks, F.lit(1).cast("bigint"), lambda n, b: n * F.size(b["options"]))


def fill_options(template: Column, blocks: Column, number: Column) -> Column:
    """The `number`-th question (from 0) of a template; the last block varies fastest.

    `number` is read as mixed-radix digits, one per block, so each question is made on its own and
    the product is never held as a whole.
    """
    state = F.struct(template.alias("text"), number.cast("bigint").alias("left"), option_count(blocks).alias("span"))

    def put(acc: Column, b: Column) -> Column:
        span = _div(acc["span"], F.size(b["options"]))
        pick = F.get(b["options"], _div(acc["left"], span).cast("int"))
        at = F.position(b["block"], acc["text"])
        text = F.concat(
            F.substring(acc["text"], F.lit(1), at - 1),
            F.when(pick == NOTHING, "").otherwise(F.concat(F.lit(" "), pick)),
            F.substring(acc["text"], at + F.length(b["block"]), F.length(acc["text"])),
        )
        return F.struct(text.alias("text"), (acc["left"] % span).alias("left"), span.alias("span"))

    filled = F.aggregate(blocks, state, put)["text"]
    return F.when(F.size(blocks) == 0, strip(template)).otherwise(strip(F.regexp_replace(filled, " {2,}", " ")))


def expand_questions(df: DataFrame, template: str = "question", out: str = "question", number: str = "option_no") -> DataFrame:
    """One row per question a template stands for, numbered from 0 in product order.

    A template of up to CHUNK questions is expanded where it lies. A larger one is cut into equal ranges of numbers, which are dealt to all
    tasks, so that one product of 10^8 questions is the work of many: what is moved is the template, once a range.
    """
    work = df.withColumn("__template", F.col(template)).withColumn("__blocks", option_blocks(F.col("__template")))
    work = work.withColumn("__n", option_count(F.col("__blocks")))
    few = work.filter(F.col("__n") <= CHUNK).withColumn("__chunk", F.lit(0).cast("bigint"))
    last = F.call_function("div", F.col("__n") - 1, F.lit(CHUNK).cast("bigint"))
    many = work.filter(F.col("__n") > CHUNK).withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    # A number of its own: else ranges, which are short rows, would be taken together again for their size.
    tasks = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = few.unionByName(many.repartition(tasks, "__chunk", F.xxhash64("__template")))
    start = F.col("__chunk") * CHUNK
    work = work.select("*", F.explode(F.sequence(start, F.least(start + CHUNK, F.col("__n")) - 1)).alias(number))
    return work.withColumn(out, fill_options(F.col("__template"), F.col("__blocks"), F.col(number))).drop("__template", "__blocks", "__n", "__chunk")
