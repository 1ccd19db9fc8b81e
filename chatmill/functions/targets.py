"""Extraction targets: strict reading, validation, key order and pretty printing of JSON text."""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.dates import format_date, parse_date
from chatmill.functions.repair import read_object
from chatmill.functions.text import let
from chatmill.schemas import PROFILE_FIELDS, FieldSpec

# Control characters that JSON text writes as \u00xx, having no short escape.
_NO_SHORT_ESCAPE = r"[\x00-\x07\x0b\x0e-\x1f]"

# Characters of a text, and levels of nesting, that an outline keeps.
_OUTLINE_TEXT, _OUTLINE_DEPTH = 1000, 8


def _inner(text: Column) -> Column:
    """The escaped text between the quotes, by Spark's own writer."""
    return let(F.to_json(F.array(text)), lambda w: F.substring(w, F.lit(3), F.length(w) - 4))


def quote(text: Column) -> Column:
    """A JSON string literal; only quotes, backslashes and control characters are escaped.

    Spark writes \\u00xx in upper case: texts that need such an escape are written character by character.
    """

    def escape(ch: Column) -> Column:
        code = F.lower(F.lpad(F.hex(F.ascii(ch)), 4, "0"))
        return F.when(ch.rlike(_NO_SHORT_ESCAPE), F.concat(F.lit("\\u"), code)).otherwise(_inner(ch))

    def body(t: Column) -> Column:
        special = F.when(~t.rlike(_NO_SHORT_ESCAPE), _inner(t)).otherwise(F.array_join(F.transform(F.split(t, "", -1), escape), ""))
        return F.when(~t.rlike(r'["\\\x00-\x1f]'), t).otherwise(special)

    return F.concat(F.lit('"'), let(text, body), F.lit('"'))


def strict_json(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, or null.

    Spark's reader stops after the first value. Put inside a list and inside an object the text must
    end there both times, which text after the value cannot do.
    """
    as_item = F.get(F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"), F.lit(0))
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(as_field.isNotNull(), as_item)


def _outlined(value, depth: int = 0):
    """The same keys and kinds in what the native reader takes: long texts cut short, numbers without NaN and infinities."""
    if isinstance(value, str):
        return value[:_OUTLINE_TEXT].encode("utf-8", "replace").decode()
    if isinstance(value, dict):
        return {_outlined(k): _outlined(v, depth + 1) for k, v in value.items()} if depth < _OUTLINE_DEPTH else {}
    if isinstance(value, list):
        return [_outlined(v, depth + 1) for v in value] if depth < _OUTLINE_DEPTH else []
    return value if value is None or isinstance(value, bool) or abs(value) < 1e18 else 0


@F.arrow_udf(T.StringType())
def _outline(text: pa.Array) -> pa.Array:
    if text.null_count == len(text):  # as most are: asked for what the native reader refused
        return pa.nulls(len(text), pa.string())

    def one(t):
        try:
            return None if t is None else json.dumps(_outlined(json.loads(t)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    return pa.array([one(t) for t in text.to_pylist()], pa.string())


def outline(text: Column) -> Column:
    """The text if it is JSON for the native reader; else a text of the same keys and kinds if Python's reader takes it; else null.

    Python's reader also takes repeated keys (the last one counts), NaN, infinities, and texts of any length. Only what the
    native reader refuses goes through an Arrow UDF.
    """
    native = strict_json(text).isNotNull()
    return F.when(native, text).otherwise(_outline(F.when(~native, text)))


def readable(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else, as Python's json.loads has it; false for null."""
    native = strict_json(text).isNotNull()
    return native | F.coalesce(_outline(F.when(~native, text)).isNotNull(), F.lit(False))


def _kind(value: Column, name: str) -> Column:
    """Type of one key: null when absent, else VOID, STRING, ARRAY<...>, ..."""
    return F.schema_of_variant(F.try_variant_get(value, f'$["{name}"]', "variant"))


def target_faults(text: Column, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> Column:
    """ARRAY<STRUCT<field, fault>>, empty for a text that holds exactly the expected fields.

    Faults: `unreadable` and `not an object` (field null), `missing`, `not a list`, `not a string`,
    `unexpected`. `text` is read by the native reader; pass `outline(text)`, as a column of its own, to take what only
    Python's reader takes.
    """
    known = F.array(*[F.lit(f.name) for f in fields])

    def fault(field: Column, what: str) -> Column:
        return F.struct(field.cast("string").alias("field"), F.lit(what).alias("fault"))

    def check(v: Column) -> Column:
        found = []
        for f in fields:
            kind = _kind(v, f.name)
            wrong = ~kind.startswith("ARRAY") if f.is_list else ~kind.isin("STRING", "VOID")
            what = "not a list" if f.is_list else "not a string"
            found.append(F.when(kind.isNull(), fault(F.lit(f.name), "missing")).when(wrong, fault(F.lit(f.name), what)))
        return (
            F.when(v.isNull(), F.array(fault(F.lit(None), "unreadable")))
            .when(~F.schema_of_variant(v).startswith("OBJECT"), F.array(fault(F.lit(None), "not an object")))
            .otherwise(F.array_compact(F.array(*found)))
        )

    extra = F.transform(F.array_except(F.json_object_keys(text), known), lambda k: fault(k, "unexpected"))
    return F.concat(let(strict_json(text), check), F.coalesce(extra, F.array()))


@F.arrow_udf(T.StringType())
def _pretty(targets: pa.Array) -> pa.Array:
    """JSON text of structs of (text, order, field, day), as `with_ordered_target` writes it; null for null and for texts that are no object."""
    if targets.null_count == len(targets):
        return pa.nulls(len(targets), pa.string())

    def one(t: dict | None) -> str | None:
        value = None if t is None or t["text"] is None else read_object(t["text"])
        if value is None:
            return None
        if isinstance(value.get(t["field"]), str):
            value[t["field"]] = t["day"]
        rank = {name: i for i, name in enumerate(t["order"])}
        placed = sorted(value, key=lambda k: rank.get(k, len(rank)))
        return json.dumps({k: value[k] for k in placed}, ensure_ascii=False, indent=2).encode("utf-8", "replace").decode()

    return pa.array([one(t) for t in targets.to_pylist()], pa.string())


TARGET = "__target"


def read_targets(df: DataFrame, text: str, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> DataFrame:
    """Add `__target`, what `with_ordered_target` needs of a JSON text: read it once, before a sample is multiplied to its variants.

    A struct of `plain` (whether built-in expressions can write it), `keys`, `lines` (of each known field, the date field's aside, its line as it is
    printed), `date`, and `text` (the text if it is not plain).
    """
    texts, lists = [f for f in fields if not f.is_list], [f for f in fields if f.is_list]
    date_field = next((f.name for f in fields if f.is_date), "")
    known = F.array(*[F.lit(f.name) for f in texts + lists])
    value, keys, is_plain, typed = F.col("__value"), F.col("__keys"), F.col("__plain"), F.col("__typed")

    def fits(f: FieldSpec) -> Column:
        kinds = ("ARRAY<STRING>", "ARRAY<VOID>") if f.is_list else ("STRING", "VOID")
        return F.coalesce(_kind(value, f.name).isin(*kinds), F.lit(True))

    def literal(x: Column) -> Column:
        return F.coalesce(quote(x), F.lit("null"))

    def block(items: Column) -> Column:
        lines = F.transform(items, lambda x: F.concat(F.lit("    "), literal(x)))
        return F.when(F.size(items) == 0, "[]").otherwise(F.concat(F.lit("[\n"), F.array_join(lines, ",\n"), F.lit("\n  ]")))

    schema = T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if f.is_list else T.StringType()) for f in fields])
    no_others = value.isNotNull() & F.coalesce(F.size(F.array_except(keys, known)) == 0, F.lit(False))
    # Step by step, so that what is used several times is computed once per row; the values are written by one
    # expression for all text fields and one for all list fields, which keeps the plan small.
    df = df.withColumns({"__value": strict_json(F.col(text)), "__keys": F.json_object_keys(text)})
    df = df.withColumn("__plain", reduce(lambda a, b: a & b, map(fits, fields), no_others))
    df = df.withColumns({"__typed": F.when(is_plain, F.from_json(text, schema)), "__odd": _outline(F.when(value.isNull(), F.col(text)))})
    date = F.when(is_plain, typed[date_field]).otherwise(F.get_json_object(F.coalesce("__odd", text), f"$.{date_field}")) if date_field else F.lit(None).cast("string")
    plain_texts = F.transform(F.array(*[typed[f.name] for f in texts]), literal)
    plain_lists = F.transform(F.array(*[typed[f.name] for f in lists]), block) if lists else F.array().cast("array<string>")
    lines = F.zip_with(known, F.concat(plain_texts, plain_lists), lambda k, v: F.concat(F.lit("  "), quote(k), F.lit(": "), v))
    found = F.struct(is_plain.alias("plain"), keys.alias("keys"), F.when(is_plain, lines).alias("lines"), date.alias("date"), F.when(~is_plain, F.col(text)).alias("text"))
    return df.withColumn(TARGET, found).drop("__value", "__keys", "__plain", "__typed", "__odd")


def with_ordered_target(
    df: DataFrame,
    text: str,
    order: Column,
    fmt: Column,
    out: str = "target",
    fields: tuple[FieldSpec, ...] = PROFILE_FIELDS,
) -> DataFrame:
    """Add JSON text with its keys in `order` (unlisted keys follow in source order) and dates in notation `fmt`.

    Two-space pretty print, non-ASCII kept. Records of strings, nulls and lists of strings, which is what
    the schema asks for, are written by built-in expressions; only a record with other values in its lists
    or with unknown keys is sent to an Arrow UDF, which sees null for all others. Targets that `read_targets` has read are not read again.
    """
    names = [f.name for f in fields if not f.is_list] + [f.name for f in fields if f.is_list]
    known = F.array(*map(F.lit, names))
    date_field = next((f.name for f in fields if f.is_date), "")
    df = df if TARGET in df.columns else read_targets(df, text, fields)
    target = F.col(TARGET)
    df = df.withColumn("__parsed", parse_date(target["date"]))
    df = df.withColumn("__day", F.coalesce(format_date(F.col("__parsed"), fmt), target["date"]))
    keys = target["keys"]
    df = df.withColumn("__full", F.when(target["plain"], F.concat(F.array_intersect(order, keys), F.array_except(keys, order))))
    day = F.concat(F.lit("  "), quote(F.lit(date_field)), F.lit(": "), F.coalesce(quote(F.col("__day")), F.lit("null")))
    # The lines with the date's own put in its place.
    lines = F.concat(F.slice(target["lines"], 1, names.index(date_field)), F.array(day), F.slice(target["lines"], names.index(date_field) + 2, len(names))) if date_field else target["lines"]
    # Bound first: inside the lambda they would be put together again for every key.
    lines = let(lines, lambda held: F.transform("__full", lambda k: F.get(held, F.array_position(known, k).cast("int") - 1)))
    native = F.when(F.size("__full") == 0, "{}").otherwise(F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}")))
    odd = F.struct(target["text"].alias("text"), order.alias("order"), F.lit(date_field).alias("field"), F.col("__day").alias("day"))
    others = _pretty(F.when(~target["plain"], odd))
    return df.withColumn(out, F.coalesce(F.when(target["plain"], native), others)).drop(TARGET, "__parsed", "__day", "__full")
