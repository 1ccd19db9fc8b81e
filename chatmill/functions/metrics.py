"""Scores of a reply against a reference answer.

Exact match, token F1 and the two n-gram scores are built-in expressions and stay inside the JVM.
The two scores that need a sequence alignment run as one Arrow UDF.
"""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.text import fold_spaces, let, normalize, strip_thinking


def words(text: Column) -> Column:
    """White-space tokens of the lower-cased text."""
    return F.filter(F.split(fold_spaces(F.lower(text)), " ", -1), lambda t: t != "")


def rouge_tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-cased text; every other character separates."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+", -1), lambda t: t != "")


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens as one text each; none for fewer than two tokens."""
    return let(tokens, lambda s: F.filter(F.transform(s, lambda x, i: F.when(i > 0, F.concat_ws(" ", F.get(s, i - 1), x))), lambda g: g.isNotNull()))


def _count_repeats(tokens: Column) -> Column:
    """Make repeated tokens distinct: the k-th copy of `t` (k > 1) becomes `t k`.

    Sorts once and walks the runs, so the cost stays at n log n for long texts.
    """

    def number_runs(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda _, i: i), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def copies(st: Column) -> Column:
            def run(at: Column, j: Column) -> Column:
                length = F.coalesce(F.get(st, j + 1), F.size(s)) - at
                return F.transform(
                    F.sequence(F.lit(1), length),
                    lambda k: F.when(k == 1, F.get(s, at)).otherwise(F.concat_ws(" ", F.get(s, at), k.cast("string"))),
                )

            return F.flatten(F.transform(st, run))

        return let(starts, copies)

    return let(F.sort_array(tokens), number_runs)


def _further_copies(tokens: Column) -> Column:
    """Each token one time less than it occurs."""
    return let(F.sort_array(tokens), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))


def bag_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two token arrays (neither token may end in a space and a number).

    Tokens that both have count once, as sets; only further copies, mostly few, are told apart by number.
    """
    both = lambda x: F.size(F.array_intersect(F.get(x, F.lit(0)), F.get(x, F.lit(1))))
    return let(F.array(a, b), lambda x: both(x) + both(F.transform(x, lambda y: _count_repeats(_further_copies(y)))))


def f_measure(overlap: Column, n_pred: Column, n_ref: Column) -> Column:
    """Harmonic mean of overlap / n_pred and overlap / n_ref; 0 when there is no overlap."""
    p, r = overlap / n_pred, overlap / n_ref
    return F.when(overlap > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def _bag_f(pair: Column) -> Column:
    return let(
        bag_overlap(pair["p"], pair["r"]),
        lambda overlap: f_measure(overlap, F.size(pair["p"]), F.size(pair["r"])),
    )


def _word_pair(pred: Column, ref: Column) -> Column:
    return F.struct(words(pred).alias("p"), words(ref).alias("r"))


def _rouge_pairs(pred: Column, ref: Column) -> Column:
    """Token pairs of the one-gram and the two-gram score."""
    ones = F.transform(F.array(pred, ref), rouge_tokens)

    def pairs(one: Column) -> Column:
        return let(
            F.transform(one, bigrams),
            lambda two: F.transform(F.array(one, two), lambda x: F.struct(F.get(x, F.lit(0)).alias("p"), F.get(x, F.lit(1)).alias("r"))),
        )

    return let(ones, pairs)


def levenshtein_sim(pred: Column, ref: Column) -> Column:
    """One minus the edit distance of the normalised texts over the length of the longer one; 1 for two empty texts."""

    def score(two: Column) -> Column:
        longer = F.greatest(F.length(two["a"]), F.length(two["b"]))
        return F.when(longer > 0, 1 - F.levenshtein(two["a"], two["b"]) / longer).otherwise(1.0)

    return let(F.struct(normalize(pred).alias("a"), normalize(ref).alias("b")), score)


def exact_match(pred: Column, ref: Column) -> Column:
    return (normalize(pred) == normalize(ref)).cast("double")


def token_f1(pred: Column, ref: Column) -> Column:
    return let(_word_pair(pred, ref), _bag_f)


def rouge_1_2(pred: Column, ref: Column) -> Column:
    """STRUCT<rouge1_f, rouge2_f>, rounded to 6 places."""
    scores = F.transform(_rouge_pairs(pred, ref), _bag_f)
    return let(scores, lambda s: F.struct(*[F.bround(F.get(s, F.lit(i)), 6).alias(f"rouge{i + 1}_f") for i in range(2)]))


_WORD = re.compile("[a-z0-9]+")


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one big-integer step per token of `b`.

    Bit i of `free` is 0 where the best subsequence grows at position i of `a`.
    """
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for token in b:
        hit = free & places.get(token, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def rouge_l(pred: str, ref: str) -> float:
    p, r = _WORD.findall(pred.lower()), _WORD.findall(ref.lower())
    common = lcs_length(p, r)
    if common == 0:
        return 0.0
    precision, recall = common / len(p), common / len(r)
    return round(2 * precision * recall / (precision + recall), 6)


def edit_similarity(pred: str, ref: str) -> float:
    """Matching-block ratio of the normalised texts; the order of the arguments matters."""
    a, b = (" ".join(t.lower().split()) for t in (pred, ref))
    return difflib.SequenceMatcher(None, a, b).ratio() if a or b else 1.0


@F.pandas_udf(T.StructType([T.StructField("rougeL_f", T.DoubleType()), T.StructField("edit_sim", T.DoubleType())]))
def alignment_scores(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
    """STRUCT<rougeL_f, edit_sim> of (prediction, reference); null when either is null."""
    rows = [
        (None, None) if p is None or r is None else (rouge_l(p, r), edit_similarity(p, r))
        for p, r in zip(pred, ref, strict=True)
    ]
    return pd.DataFrame(rows, columns=["rougeL_f", "edit_sim"], dtype="float64")


def score_columns(df, raw: str = "raw_response", truth: str = "ground_truth", alignment: bool = True):
    """Add `response` (the reply without its reasoning) and the metric columns.

    `alignment=False` leaves out the two Arrow-UDF scores, keeping the job free of Python workers.
    """
    df = df.withColumn("response", strip_thinking(F.col(raw)))
    pred, ref = F.col("response"), F.col(truth)
    # One expression for the three bag scores keeps the plan small.
    bags = F.transform(F.concat(F.array(_word_pair(pred, ref)), _rouge_pairs(pred, ref)), _bag_f)
    df = df.withColumns({"exact_match": exact_match(pred, ref), "__bags": bags})
    one, two = (F.bround(F.get("__bags", F.lit(i)), 6) for i in (1, 2))
    df = df.withColumns({"token_f1": F.get("__bags", F.lit(0)), "rouge1_f": one, "rouge2_f": two}).drop("__bags")
    if alignment:
        df = df.withColumn("__al", alignment_scores(pred, ref))
        df = df.withColumns({"rougeL_f": F.col("__al.rougeL_f"), "edit_sim": F.col("__al.edit_sim")}).drop("__al")
    return df
