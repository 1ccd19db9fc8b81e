"""Variants of a sample: field order and date notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.dates import DATE_LABELS, SOURCE_FORMAT
from chatmill.functions.keys import hash_number, seeded_key
from chatmill.schemas import PROFILE_FIELDS, FieldSpec


def shuffled_fields(names: list[str], seed: int, *ids: Column | str) -> Column:
    """The names in a random order fixed by the seed and the ids."""
    keyed = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.struct(seeded_key(seed, *ids, n).alias("h"), n.alias("n")))
    return F.transform(F.array_sort(keyed), lambda x: x["n"])


def other_format(seed: int, *ids: Column | str) -> Column:
    """A date notation other than the source one, all equally likely."""
    return (F.pmod(hash_number(seeded_key(seed, *ids, F.lit("date"))), F.lit(len(DATE_LABELS) - 1)) + 1 + SOURCE_FORMAT).cast("int")


def with_variants(
    df: DataFrame,
    sample: Column | str,
    extra: Column | int,
    seed: int = 42,
    fields: tuple[FieldSpec, ...] = PROFILE_FIELDS,
) -> DataFrame:
    """One row per variant of a sample with `variant`, `field_order` and `date_fmt`.

    Variant 0 keeps the field order and the source notation; `extra` more follow (a column may turn
    them off for some rows, as for the eval side of a split).
    """
    names = [f.name for f in fields]
    extra = F.lit(extra) if isinstance(extra, int) else extra
    rows = df.select("*", F.explode(F.sequence(F.lit(0), extra.cast("int"))).alias("variant"))
    first = F.col("variant") == 0
    return rows.withColumns(
        {
            "field_order": F.when(first, F.array(*[F.lit(n) for n in names])).otherwise(shuffled_fields(names, seed, sample, "variant")),
            "date_fmt": F.when(first, SOURCE_FORMAT).otherwise(other_format(seed, sample, "variant")),
        }
    )
