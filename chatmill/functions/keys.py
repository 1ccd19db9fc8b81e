"""Seeded keys: the same seed and row give the same choice on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(seed: int, *parts: Column | str) -> Column:
    """md5 text of the seed and the parts, spread evenly over the hash space."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_number(key: Column, digits: int = 8) -> Column:
    """The first hex digits of an md5 text as a number."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")
