"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.worker import kept
from chatmill.operators.staging import stage

# Letters of other scripts, digits and signs that are written for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ℓ": "l", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y", "ᴀ": "a", "ᴇ": "e", "ᴏ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

# Phrases in which a listed word is harmless, in folded form.
EXCEPTIONS = (
    "clown fish", "class clown", "circus clown", "rodeo clown", "white trash bag", "trash can", "trash bin", "trash bag", "trash talk",
    "pond scum", "soap scum", "sore loser", "no idiot", "idiot proof", "stupid question",
)

# Labelled rows that are learned from, at most: those whose keys have the smallest hashes. So few are broadcast, and no text
# is shuffled to meet its label.
LABELLED = 20_000
# Entries that a task counts before it passes them on.
HELD_ENTRIES = 300_000

_STRAY = re.compile(r"[0-9@$!|]+")
_NO_LETTERS = re.compile(r"[^\w]+|_+")
_PLAIN = {ord(k): v for k, v in LOOKALIKES.items()}
_SWAPPED = str.maketrans(DIGITS)
_MIXED = re.compile(r"(?=[^\s]*[a-z])[a-z0-9@$!|]*[a-z][a-z0-9@$!|]*")


def fold(text: str) -> str:
    """Words in small letters with one space between: lookalike letters, and digits or signs inside words, as the letters they stand for.

    Accents stay (they tell words of other languages apart). A run of digits or signs without a letter beside it is left
    as a number; signs at the end of a word are taken as punctuation.
    """
    small = text.lower()
    if not small.isascii():
        small = unicodedata.normalize("NFKC", small).translate(_PLAIN)
    if _STRAY.search(small):
        small = _MIXED.sub(lambda m: m[0].rstrip("!|$@").translate(_SWAPPED) + " ", small)
    return " ".join(_NO_LETTERS.sub(" ", small).split())


@dataclass(frozen=True)
class Lexicon:
    """Weighted word beginnings, phrases that excuse them, and the scores of strength bands.

    `weights`: beginnings of words (a full word ends with a space) with their weights. `bands`: upper limits of strength
    with the toxic share of each band, rising.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bands: tuple[tuple[float, float], ...] = field(default=((0.0, 0.05), (math.inf, 0.95)))

    def score(self, strength: float) -> float:
        return next(share for limit, share in self.bands if strength <= limit)


def matcher(lexicon: Lexicon):
    """A function from text to (strength, hits, words)."""
    import ahocorasick

    tree = ahocorasick.Automaton()
    for entry, weight in lexicon.weights.items():
        tree.add_word(f" {entry}", (len(entry) + 1, weight))
    for phrase in lexicon.exceptions:
        if f" {phrase} " not in tree:
            tree.add_word(f" {phrase} ", (len(phrase) + 2, None))
    if len(tree):
        tree.make_automaton()

    def strength(text: str | None) -> tuple[float, int, int]:
        if not text:
            return 0.0, 0, 0
        folded = f" {fold(text)} "
        words = folded.count(" ") - 1 if len(folded) > 2 else 0
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (length, weight) in tree.iter(folded) if len(tree) else ():
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):  # one weight for a word, its best
                best[start] = weight
        if excused:
            spans, kept, at = sorted(excused), {}, 0
            reach = -1
            for start in sorted(best):
                while at < len(spans) and spans[at][0] <= start:
                    reach = max(reach, spans[at][1])
                    at += 1
                if start >= reach:
                    kept[start] = best[start]
            best = kept
        # Against the square root of the length: a long text needs more hits, but not in proportion.
        return sum(best.values()) / math.sqrt(words + 10) * 10, len(best), words

    return strength


def with_strength(df: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "strength") -> DataFrame:
    """Add struct<strength double, hits long, words long>. Null, empty and wordless texts have strength 0."""
    ship(df.sparkSession)
    given = df.sparkSession.sparkContext.broadcast(lexicon)
    key = hash((tuple(sorted(lexicon.weights.items())), lexicon.exceptions))
    kind = T.StructType([T.StructField("strength", T.DoubleType()), T.StructField("hits", T.LongType()), T.StructField("words", T.LongType())])

    @F.pandas_udf(kind)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        strength = kept(f"toxicity {key}", key, lambda: matcher(given.value))
        for texts in batches:
            yield pd.DataFrame([strength(t) for t in texts], columns=["strength", "hits", "words"]).astype({"strength": "float64", "hits": "int64", "words": "int64"})

    return df.withColumn(out, measure(F.col(text)))


def _beginnings(df: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Beginnings of words (full words end with a space), and the texts of label 1 and 0 that hold them.

    `df` has the columns __text and __label. Each task counts what it reads before anything is shuffled; what it holds is
    bounded, as full counters are passed on.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pd.DataFrame:
            entries = list(seen[0].keys() | seen[1].keys())
            out = pd.DataFrame({"entry": pd.Series(entries, dtype=object), "a": pd.Series([seen[1][e] for e in entries], dtype="int64"), "b": pd.Series([seen[0][e] for e in entries], dtype="int64")})
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for text, label in zip(batch["__text"], batch["__label"], strict=True):
                found: set[str] = set()
                for w in set(fold(text or "").split()):
                    found.update([w[:n] for n in range(shortest, min(longest, len(w)) + 1)])
                    if 2 <= len(w) <= longest:
                        found.add(w + " ")
                seen[label].update(found)
                if len(seen[0]) + len(seen[1]) > HELD_ENTRIES:
                    yield rows()
        if seen[0] or seen[1]:
            yield rows()

    return df.select("__text", "__label").mapInPandas(count, "entry string, a long, b long").groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def learn_lexicon(
    df: DataFrame,
    text: str,
    label: str,
    shortest: int = 4,
    longest: int = 14,
    least_gain: float = 12.0,
    least_weight: float = 2.0,
    most_entries: int = 20_000,
) -> Lexicon:
    """Learn the weighted beginnings of words from rows whose `label` is 0 or 1 (others are passed over).

    For each beginning the texts of either label that hold it are counted in Spark. It is listed if its log odds are
    `least_weight` or more, it tells the labels apart by a likelihood ratio of `least_gain` or more, and a shorter listed
    beginning does not do as well. The driver gets the entries that pass the tests only, at most `most_entries` by their
    gain: a bound of the model, not of the rows that it is counted from. Without rows of both labels the list is empty.
    """
    df = df.select(F.col(text).alias("__text"), F.col(label).cast("int").alias("__label")).filter(F.col("__label").isin(0, 1))
    totals = {r["__label"]: r["n"] for r in df.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Lexicon({}, EXCEPTIONS, ((math.inf, (bad + 0.5) / (bad + good + 1)),))
    counts = _beginnings(df, shortest, longest)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = bad / (bad + good)
    gain = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    weight = F.log((a + 0.5) / (bad + 1)) - F.log((b + 0.5) / (good + 1))
    passed = counts.select("entry", "a", "b", weight.alias("weight"), gain.alias("gain")).filter((F.col("weight") >= least_weight) & (F.col("gain") >= least_gain))
    found = {r["entry"]: (r["weight"], r["gain"]) for r in passed.orderBy(F.desc("gain"), "entry").limit(most_entries).collect()}
    weights: dict[str, float] = {}
    for entry in sorted(found, key=len):
        shorter = [entry[:n] for n in range(1, len(entry)) if entry[:n] in weights]
        if not any(found[s][1] >= found[entry][1] * 0.8 for s in shorter):
            weights[entry] = found[entry][0]
    return Lexicon(weights)


def calibrate(df: DataFrame, lexicon: Lexicon, strength: str, label: str, steps: int = 24) -> Lexicon:
    """The lexicon with the toxic share of each band of strength, from rows that have strength and label.

    Bands are fixed steps of the logarithm of strength (a bounded number of counts comes to the driver); neighbours whose
    shares would fall are joined, so that the score never falls with strength.
    """
    band = F.when(F.col(strength) <= 0, 0).otherwise(F.least(F.lit(steps), F.greatest(F.lit(1), F.floor(F.log2(F.col(strength) + 1) * 3) + 1))).cast("int")
    rows = df.filter(F.col(label).isin(0, 1)).groupBy(band.alias("band")).agg(F.sum(F.col(label).cast("long")).alias("a"), F.count(F.lit(1)).alias("n")).collect()
    blocks: list[list[float]] = []  # lower band, toxic, all
    for r in sorted(rows, key=lambda r: r["band"]):
        blocks.append([r["band"], r["a"], r["n"]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, more, n = blocks.pop()
            blocks[-1][1] += more
            blocks[-1][2] += n
    if not blocks:
        return lexicon
    limits = [0.0 if nxt[0] == 1 else 2 ** ((nxt[0] - 1) / 3) - 1 for nxt in blocks[1:]] + [math.inf]
    return Lexicon(lexicon.weights, lexicon.exceptions, tuple((limit, (a + 0.5) / (n + 1)) for limit, (_, a, n) in zip(limits, blocks, strict=True)))


def _share(strength: Column, lexicon: Lexicon) -> Column:
    out = F.lit(lexicon.bands[-1][1])
    for limit, share in reversed(lexicon.bands[:-1]):
        out = F.when(strength <= limit, F.lit(share)).otherwise(out)
    return out


def is_held_out(key: Column, of: int, rest: int = 2) -> Column:
    """Whether crc32 of the key as text leaves `rest` when divided by `of`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of == rest


def _taught(labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """(__key, __label) of at most `most` keys that may be learned from; a key labelled more than once is toxic if any label says so."""
    named = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    usable = named.filter(F.col("__key").isNotNull() & F.col("__label").isin(0, 1) & ~is_held_out(F.col("__key"), 4))
    known = usable.groupBy("__key").agg(F.max("__label").alias("__label"))
    # Written once, so that every pass over the texts sees the same rows.
    return F.broadcast(stage(known.orderBy(F.xxhash64(F.col("__key").cast("string")), "__key").limit(most), "labels"))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", limit: float = 0.3, labelled: int = LABELLED) -> DataFrame:
    """Score all texts by a lexicon that is learned from labelled ones.

    Returns one row per row of `docs`: key, held_out (crc32 of the key mod 4 is 2: its label is not learned from), score
    (0 to 1), predicted (1 from `limit` on), hits and words. Labels match by key; at most `labelled` of them are used, a key
    labelled more than once counts as toxic if any of its labels says so, and null keys have no label. Null, empty and
    wordless texts get the score of texts without a hit. Without labels of both kinds the score is one value for all. The
    strengths are written to the shared folder once: the labelled ones set the bands, then all are scored.
    """
    ship(docs.sparkSession)
    known = _taught(labels, key, label, labelled)
    texts = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    lexicon = learn_lexicon(texts.join(known, "__key"), "__text", "__label")
    measured = stage(with_strength(texts, lexicon, "__text", "__m").select("__key", "__m.*"), "toxicity")
    lexicon = calibrate(measured.join(known, "__key"), lexicon, "strength", "__label") if lexicon.weights else lexicon
    score = _share(F.col("strength"), lexicon)
    return measured.select(
        F.col("__key").alias(key),
        is_held_out(F.col("__key"), 4).alias("held_out"),
        score.alias("score"),
        (score >= limit).cast("int").alias("predicted"),
        "hits",
        "words",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", limit: float = 0.3, labelled: int = LABELLED) -> DataFrame:
    """The rows of `docs` whose score is below `limit`, unchanged. Labels, null keys and empty texts as in `score_toxicity`."""
    ship(docs.sparkSession)
    taught = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(_taught(labels, key, label, labelled), "__key")
    lexicon = learn_lexicon(taught, "__text", "__label")
    if lexicon.weights:
        lexicon = calibrate(with_strength(taught, lexicon, "__text", "__m").select("__m.strength", "__label"), lexicon, "strength", "__label")
    return with_strength(docs, lexicon, text, "__m").filter(_share(F.col("__m.strength"), lexicon) < limit).drop("__m")
