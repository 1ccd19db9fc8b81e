"""Keyed permutations of number ranges by Feistel rounds, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
# Extra walks for numbers that fall outside the range. A walk passes each outside number at most once, and there are fewer
# of them than the square root of the range: up to a range of 4096 this many walks always suffice, and beyond it the
# chance that they don't is below 64 ** -64.
WALKS = 64

#: (what the round is keyed by, text or number; round; half) -> any long
Mixer = Callable[[Column, Column, Column], Column]


def fast_mixer(key: Column, turn: Column, half: Column) -> Column:
    return F.xxhash64(key, turn, half)


def strong_mixer(key: Column, turn: Column, half: Column) -> Column:
    """The first 60 bits of a SHA-256, for keys that must not be found from the results."""
    digest = F.sha2(F.concat_ws(":", key.cast("string"), turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute_pair(left: Column, right: Column, a: Column, b: Column, key: Column, mixer: Mixer = fast_mixer) -> Column:
    """struct<l, r>: a permutation of the pairs with 0 <= l < a and 0 <= r < b; each round shifts one half by a hash of the other."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        half = F.when(odd, s["r"]).otherwise(s["l"])
        shift = mixer(key, i, half)
        return F.struct(
            F.when(odd, F.pmod(s["l"] + F.pmod(shift, a), a)).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(shift, b), b)).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def permute(x: Column, n: Column, key: Column, mixer: Mixer = fast_mixer) -> Column:
    """A permutation of 0 .. n - 1 (n < 2 ** 62), different for each key: pairs of about the square root, walked until inside."""
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("long")
    b = F.greatest(F.lit(1), F.ceil(n / a)).cast("long")

    def once(v: Column) -> Column:
        return F.transform(F.array(permute_pair(F.floor(v / b), v % b, a, b, key, mixer)), lambda p: p["l"] * b + p["r"])[0]

    def walked(v: Column) -> Column:
        more = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), v, lambda w, _: F.when(w < n, w).otherwise(once(w)))
        return F.when(v < n, v).otherwise(more)

    return F.transform(F.array(once(x.cast("long"))), walked)[0]
