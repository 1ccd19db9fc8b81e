"""Token counts by byte-pair merging, without making ids."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.byte_level import SPLIT, Pieces, read_merges
from chatmill.llm.worker import kept

# Pieces remembered by a Python worker, and the longest one remembered (in characters). They bound its memory only:
# a piece that isn't remembered is merged again.
REMEMBERED, LONGEST = 400_000, 48


def merged_length(symbols: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left when adjacent pairs are merged, the pair of lowest rank first, the leftmost first among equals.

    The symbols form a linked list; a heap holds the ranks of adjacent pairs. A merge makes at most two new pairs, and
    entries of pairs that are gone are skipped when they come up, so n symbols take n log n steps.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapify(heap)
    left = n
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # A rank belongs to one pair, so an entry still holds if the pair now at its place has its rank.
        if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        after[i] = k = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heappush(heap, (r, h))
    return left


class PieceLengths(dict):
    """Tokens of each piece; counted when first asked for."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]):
        super().__init__()
        self.ranks = ranks
        self.bytes = [bytes([b]) for b in range(256)]

    def __missing__(self, piece: str) -> int:
        count = merged_length([self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")], self.ranks)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = count
        return count


def text_counter(ranks: dict[tuple[bytes, bytes], int], whole: list[str], pattern: str = SPLIT):
    """A function from text to its number of tokens; each string of `whole` counts as one token where it occurs."""
    lengths, pieces = PieceLengths(ranks), Pieces(pattern)
    marks = regex.compile("|".join(regex.escape(w) for w in sorted(whole, key=len, reverse=True))) if whole else None

    def count(text: str) -> int:
        look = lengths.__getitem__
        if marks is None or not marks.search(text):
            return sum(map(look, pieces(text)))
        parts = marks.split(text)
        return len(parts) - 1 + sum(sum(map(look, pieces(p))) for p in parts)

    return count


def with_token_count(df: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens (long) that a byte-level .json vocabulary makes of a text.

    As the tokenizer library counts them by default: no begin or end tokens, no truncation, special strings inside a text
    are one token each. A null text counts as empty and has 0 tokens. A column named `out` is replaced. `vocabulary` is a
    file of the driver; its merges (as many as it lists) are broadcast. Rows are counted one by one, whole, where they lie:
    no shuffle, and a text takes memory in proportion to its longest piece.
    """
    spark = ship(df.sparkSession)
    merges = spark.sparkContext.broadcast(read_merges(vocabulary))
    key = vocabulary

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = kept("token_count", key, lambda: text_counter(*merges.value))
        for texts in batches:
            yield pd.Series([one(t) if t else 0 for t in texts], dtype="int64")

    return df.withColumn(out, count(F.col(text)))
