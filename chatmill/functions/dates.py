"""Date strings in `DD.MM.YYYY` and their six output notations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import let, strip

# Month names of the two long notations.
GERMAN_MONTHS = (
    "Januar", "Februar", "März", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Dezember",
)
ENGLISH_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# What prompts call the notations, by format number; number 0 is that of the source data.
DATE_LABELS = (
    "DD.MM.YYYY, like 24.12.2001",
    "YYYY-MM-DD, like 2001-12-24",
    "DD/MM/YYYY, like 24/12/2001",
    "MM/DD/YYYY, like 12/24/2001",
    "in German words, like 24. Dezember 2001",
    "in English words, like December 24, 2001",
)
SOURCE_FORMAT = 0


def parse_date(value: Column) -> Column:
    """DATE of a `DD.MM.YYYY` text (one-digit day and month allowed), null when it is none."""
    text = strip(value)
    return F.when(
        text.rlike(r"\A[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}\z") & ~text.endswith(".0000"),
        F.call_function("try_to_date", text, F.lit("d.M.yyyy")),
    )


def format_date(date: Column, fmt: Column) -> Column:
    """A date in notation `fmt`; the year is written without leading zeros."""
    day, month, year = F.day(date), F.month(date), F.year(date).cast("string")
    dd, mm = F.lpad(day.cast("string"), 2, "0"), F.lpad(month.cast("string"), 2, "0")

    def name(months: tuple[str, ...]) -> Column:
        return F.get(F.array(*[F.lit(m) for m in months]), month - 1)

    texts = (
        F.concat_ws(".", dd, mm, year),
        F.concat_ws("-", year, mm, dd),
        F.concat_ws("/", dd, mm, year),
        F.concat_ws("/", mm, dd, year),
        F.concat(day.cast("string"), F.lit(". "), name(GERMAN_MONTHS), F.lit(" "), year),
        F.concat(name(ENGLISH_MONTHS), F.lit(" "), dd, F.lit(", "), year),
    )
    out = F.when(fmt == 0, texts[0])
    for number, text in enumerate(texts[1:], 1):
        out = out.when(fmt == number, text)
    return F.when(date.isNotNull(), out)


def reformat_date(value: Column, fmt: Column) -> Column:
    """A date string in notation `fmt`; null stays null, a text that is no date stays as it is."""
    return let(parse_date(value), lambda d: F.coalesce(format_date(d, fmt), value))


def with_notations(df: DataFrame, value: str, names: list[str], formats: list[int] | None = None) -> DataFrame:
    """Add a date string in several notations (numbered from 0, all of them by default), as `reformat_date` has it; the date is read once, as a column."""
    read = df.withColumn("__date", parse_date(F.col(value)))
    texts = [F.coalesce(format_date(F.col("__date"), F.lit(f)), F.col(value)).alias(n) for n, f in zip(names, formats or range(len(DATE_LABELS)), strict=True)]
    return read.select("*", *texts).drop("__date")
