"""Reading one JSON object out of a model reply.

Reasoning blocks and code fences go in the JVM; what is left is read by a short ladder of repairs in
an Arrow UDF, because only the stdlib reader has the wanted strictness: Spark's JSON readers accept
text after the object, and refuse repeated keys and NaN.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.text import strip_code_fences, strip_think_blocks

# A string literal (closed or cut off), or one bracket outside of any string.
_PIECE = re.compile(r'"(?:\\.|[^"\\])*(?:"|\\?\Z)|[][{}]', re.DOTALL)

# The textual repairs.
_TRAILING_COMMA = re.compile(r",\s*([}\]])")
_QUOTED_KEY = re.compile(r"'([^']*?)'(\s*:)")
_QUOTED_VALUE = re.compile(r"(:\s*)'([^']*?)'")


def brackets(text: str, start: int = 0) -> Iterator[tuple[int, str]]:
    """(position, bracket) of every bracket outside of double-quoted strings."""
    for piece in _PIECE.finditer(text, start):
        if text[piece.start()] != '"':
            yield piece.start(), piece.group()


def first_object(text: str) -> str | None:
    """The text from the first `{` to the brace that closes it, or None."""
    start = text.find("{")
    if start < 0:
        return None
    level = 0
    for at, bracket in brackets(text, start):
        level += {"{": 1, "}": -1}.get(bracket, 0)
        if level == 0:
            return text[start : at + 1]
    return None


def drop_trailing_commas(text: str) -> str:
    return _TRAILING_COMMA.sub(r"\1", text)


def double_quotes(text: str) -> str:
    """Turn single-quoted keys and values (not list items) into double-quoted ones."""
    return _QUOTED_VALUE.sub(r'\1"\2"', _QUOTED_KEY.sub(r'"\1"\2', text))


def close_brackets(text: str) -> str:
    """Append what is missing: all `]` first, then all `}`."""
    seen = "".join(bracket for _, bracket in brackets(text))
    return text + "]" * (seen.count("[") - seen.count("]")) + "}" * (seen.count("{") - seen.count("}"))


def read_object(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def repair_object(text: str) -> tuple[dict | None, str | None]:
    """(object, name of the step that read it) of a reply without reasoning and fences."""
    value = read_object(text)
    if value is not None:
        return value, "direct"
    found = first_object(text)
    if found is not None and found != text:
        value = read_object(found)
        if value is not None:
            return value, "object"
        text = found
    for name, step in (("commas", drop_trailing_commas), ("quotes", double_quotes), ("brackets", close_brackets)):
        text = step(text)
        value = read_object(text)
        if value is not None:
            return value, name
    return None, None


def _dump(value) -> str | None:
    """JSON text that can be encoded; lone surrogates stay escaped."""
    try:
        text = json.dumps(value, ensure_ascii=False)
        text.encode()
    except UnicodeEncodeError:
        text = json.dumps(value)
    except RecursionError:
        return None
    return text


def _plain(value):
    """Equal values become equal texts: whole numbers, and true and false, as integers, at any depth."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, (bool, int)) or isinstance(value, float) and value.is_integer() else value


def _view(value: dict, names: list[str]) -> str:
    """The named fields as `[{"k": kind, "s": text, "l": items}, ...]`, the shape of FIELD_VIEW."""
    out = []
    for name in names:
        v = value.get(name)
        if v is None:
            out.append({"k": "null"})
        elif isinstance(v, str):
            out.append({"k": "text", "s": v})
        elif isinstance(v, list):
            out.append({"k": "list", "l": [str(x) for x in v]})
        elif isinstance(v, (int, float)):
            out.append({"k": "nan"} if v != v else {"k": "value", "s": repr(_plain(v))})
        else:
            out.append({"k": "value", "s": json.dumps(_plain(v), sort_keys=True)})
    return _dump(out)


# Kinds: null (also for an absent field), text, list, value (any other), nan (equal to nothing).
FIELD_VIEW = "array<struct<k:string,s:string,l:array<string>>>"


_READ = [T.StructField("json", T.StringType()), T.StructField("strategy", T.StringType())]
_VIEWS = [T.StructField("reply_view", T.StringType()), T.StructField("truth_view", T.StringType())]


@F.pandas_udf(T.StructType(_READ))
def _repair(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        value, step = (None, None) if t is None else repair_object(t)
        rows.append((None if value is None else _dump(value), step))
    return pd.DataFrame(rows, columns=["json", "strategy"], dtype=object)


def clean_reply(text: Column) -> Column:
    """A reply without reasoning blocks and code fences."""
    return strip_code_fences(strip_think_blocks(text))


def parse_reply(text: Column) -> Column:
    """STRUCT<json, strategy>: the first object a reply holds, as JSON text; both null if there is none."""
    return _repair(clean_reply(text))


def field_views(names: list[str]):
    """UDF (cleaned reply, truth text) -> STRUCT<json, strategy, reply_view, truth_view>.

    The reply goes through the repair ladder; the truth must be strict JSON and counts as `{}` otherwise.
    The views are JSON texts of shape FIELD_VIEW, so only strings cross the Arrow boundary.
    """

    @F.pandas_udf(T.StructType(_READ + _VIEWS))
    def views(reply: pd.Series, truth: pd.Series) -> pd.DataFrame:
        rows = []
        for r, t in zip(reply, truth, strict=True):
            value, step = (None, None) if r is None else repair_object(r)
            known = (None if t is None else read_object(t)) or {}
            rows.append(
                (
                    None if value is None else _dump(value),
                    step,
                    _view(value or {}, names),
                    _view(known, names),
                )
            )
        return pd.DataFrame(rows, columns=["json", "strategy", "reply_view", "truth_view"], dtype=object)

    return views
