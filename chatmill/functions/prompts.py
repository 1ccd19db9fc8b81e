"""System prompts. The wording is this library's own and can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.functions.dates import DATE_LABELS
from chatmill.functions.text import let
from chatmill.schemas import PROFILE_FIELDS, FieldSpec

DOCUMENT_PREAMBLE = (
    "You look things up in one document.\n"
    "Copy what the document says, word for word, and stop there. Several lines stay several lines.\n\n"
    "--- text of the document ---\n"
)


@dataclass(frozen=True)
class SchemaWording:
    """Texts of the extraction prompt; `{date}` in a field description or rule is the date label."""

    intro: str = "Turn the application that follows into a JSON object. Its keys, from first to last:"
    rules: tuple[str, ...] = (
        "* The reply starts with { and ends with }.",
        "* Nothing said about a text key: null. Nothing said about a list key: [].",
        "* Days look like {date}.",
        "* Abilities go under skills; names of goods, even if the person is able with them, go under products.",
    )
    labels: tuple[str, ...] = DATE_LABELS


def _pad(name: str) -> str:
    return f"{name:<15}"


def schema_prompt(
    order: Column | list[str],
    fmt: Column | int = 0,
    fields: tuple[FieldSpec, ...] = PROFILE_FIELDS,
    wording: SchemaWording = SchemaWording(),
) -> Column:
    """Extraction prompt with one line per field in `order` and the date label of notation `fmt`.

    Unknown field names raise: at once for a Python list, at run time for a column.
    """
    names = [f.name for f in fields]
    if isinstance(order, list):
        unknown = [n for n in order if n not in names]
        if unknown:
            raise ValueError(f"unknown fields: {unknown}")
        order = F.array(*[F.lit(n) for n in order])
    fmt = F.lit(fmt) if isinstance(fmt, int) else fmt
    label = F.get(F.array(*[F.lit(x) for x in wording.labels]), fmt)
    lines = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f"  {_pad(f.name)}– {f.description}")])
    unknown = F.array_except(order, F.array(*[F.lit(n) for n in names]))
    body = let(lines, lambda m: F.array_join(F.transform(order, lambda n: m[n]), "\n"))
    text = F.concat(F.lit(wording.intro + "\n\n"), body, F.lit("\n\n" + "\n".join(wording.rules) + "\n"))
    return F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown fields: "), F.array_join(unknown, ", ")))).otherwise(
        F.replace(text, F.lit("{date}"), label)
    )
