"""Conversation records as JSON lines."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from chatmill.functions.targets import readable, strict_json
from chatmill.functions.text import strip
from chatmill.operators.ordering import first_rows
from chatmill.schemas import TURN
from chatmill.sources.files import path_exists

UNREADABLE = "not a JSON value"
TURNS = T.ArrayType(TURN)


def read_lines(spark: SparkSession, path: str | list[str], number: bool = False) -> DataFrame:
    """Non-blank lines as (`file`, `seq`, `line`), white space stripped; (`file`, `seq`) is the line order.

    `number=True` adds `line_no`, the line's place in its file from 1 (blank lines counted): the lines of earlier blocks of
    the file, from one small row per block, and the line's place in its own. No line is moved.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("seq"),
        strip(F.col("value")).alias("line"),
    )
    if number:
        blocks = raw.groupBy("file", F.col("seq.block").alias("block")).agg(F.min("seq.row").alias("first"), F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.select(F.col("file").alias("__file"), F.col("block").alias("__block"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        # One row per block that a task reads.
        here = (F.col("file") == F.col("__file")) & (F.col("seq.block") == F.col("__block"))
        raw = raw.join(F.broadcast(blocks), here).withColumn("line_no", F.col("before") + F.col("seq.row") - F.col("first") + 1)
        raw = raw.select("file", "seq", "line", "line_no")
    return raw.filter(F.col("line") != "")


def _turns(record: Column) -> Column:
    """Turns of a record VARIANT. Text content and lists of parts are told apart by their JSON type."""

    def shape(t: Column) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(t, "$.content", "variant"))
        part = "array<struct<type:string,image:string,text:string>>"

        def parts(content: Column) -> Column:
            # A part with other keys than these three is kept whole, as JSON text, next to them.
            raw = F.try_variant_get(content, "$", "array<variant>")
            known = F.try_variant_get(content, "$", part)

            def put(k: Column, r: Column) -> Column:
                text = F.to_json(r)
                more = F.size(F.array_except(F.json_object_keys(text), F.array(*[F.lit(x) for x in ("type", "image", "text")]))) > 0
                return F.struct(k["type"].alias("type"), k["image"].alias("image"), k["text"].alias("text"), F.when(more, text).alias("json"))

            return F.zip_with(known, raw, put)

        return F.struct(
            F.try_variant_get(t, "$.role", "string").alias("role"),
            F.when(kind == "STRING", F.try_variant_get(t, "$.content", "string")).alias("content"),
            F.when(kind.startswith("ARRAY"), parts(F.try_variant_get(t, "$.content", "variant"))).alias("parts"),
        )

    turns = F.transform(F.try_variant_get(record, "$.conversations", "array<variant>"), shape)
    return F.coalesce(turns, F.filter(F.array(shape(record)), lambda _: F.lit(False)))


@F.arrow_udf(T.StructType([T.StructField("turns", TURNS)]))
def _python_turns(lines: pa.Array) -> pa.Array:
    """Turns of lines read by Python's reader; null for null and for lines that it refuses too."""

    def text(value) -> str | None:
        return value.encode("utf-8", "replace").decode() if isinstance(value, str) else None if value is None else json.dumps(value, ensure_ascii=False)

    def part(p) -> dict:
        p = p if isinstance(p, dict) else {}
        others = text(p) if set(p) - {"type", "image", "text"} else None
        return {"type": text(p.get("type")), "image": text(p.get("image")), "text": text(p.get("text")), "json": others}

    def one(line: str | None) -> dict | None:
        try:
            record = None if line is None else json.loads(line)
        except (ValueError, RecursionError):
            return None
        if line is None:
            return None
        turns = record.get("conversations") if isinstance(record, dict) else None
        out = []
        for t in turns if isinstance(turns, list) else []:
            t = t if isinstance(t, dict) else {}
            content = t.get("content")
            out.append({"role": text(t.get("role")), "content": text(content) if isinstance(content, str) else None, "parts": [part(p) for p in content] if isinstance(content, list) else None})
        return {"turns": out}

    return pa.array([one(x) for x in lines.to_pylist()], to_arrow_type(T.StructType([T.StructField("turns", TURNS)])))


def read_conversations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict reader: (`file`, `seq`, `conversations`); a malformed line fails the job, whichever columns it asks for.

    Lines that only Python's reader takes (a repeated key, NaN, a very long text) are read by it, in an Arrow UDF.
    """
    lines = read_lines(spark, path).withColumn("__native", strict_json(F.col("line")).isNotNull())
    bad = F.raise_error(F.concat(F.lit("malformed line in "), F.col("file"), F.lit(": "), F.substring("line", 1, 200)))
    others = _python_turns(F.when(~F.col("__native"), F.col("line")))
    lines = lines.withColumn("__others", others)
    # In a filter, so that no choice of columns can prune the check away.
    checked = lines.filter(F.when(F.col("__native") | F.col("__others").isNotNull(), F.lit(True)).otherwise(bad.cast("boolean")))
    turns = F.when(F.col("__native"), _turns(strict_json(F.col("line")))).otherwise(F.col("__others.turns"))
    return checked.select("file", "seq", turns.alias("conversations"))


def read_tolerant(spark: SparkSession, path: str | list[str], line_numbers: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad) lines. Good lines keep their text whole, with any keys; bad ones carry the `reason`.

    Bad lines carry `line_no` too, unless `line_numbers` is off, which saves the count of lines by block.
    """
    lines = read_lines(spark, path)
    numbered = read_lines(spark, path, number=True) if line_numbers else lines
    bad = numbered.filter(~readable(F.col("line")))
    where = ["line_no"] if line_numbers else ["seq"]
    return lines.filter(readable(F.col("line"))), bad.select("file", *where, "line", F.lit(UNREADABLE).alias("reason"))


def load_train_eval(
    spark: SparkSession, train: str, evaluation: str | None = None, max_samples: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Train and eval records, both capped to the first `max_samples`; a missing eval path gives None."""

    def load(path: str) -> DataFrame:
        return first_rows(read_conversations(spark, path), ["file", "seq"], max_samples)

    found = evaluation is not None and path_exists(spark, evaluation)
    return load(train), load(evaluation) if found else None
