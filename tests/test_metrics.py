import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatmill.functions import metrics as M
from chatmill.operators.bags import bag_scores

PAIRS = [
    ("the cat", "the cat"), ("The  Cat\n", "the cat"), ("a b", "a b"), ("", ""), ("x", ""), ("", "x"), ("a b", "c d"),
    ("a b b c", "b b b a"), ("Über den Fluß", "über den fluß"), ("tide", "diet"), ("diet", "tide"), ("one", "one two"), ("... !", "?"),
    ("w1 w2 w3 " * 90, "w3 w2 w1 " * 70),
]


def f_score(common, n_pred, n_ref):
    if not common:
        return 0.0
    p, r = common / n_pred, common / n_ref
    return 2 * p * r / (p + r)


def bag_f(a, b):
    return f_score(sum((Counter(a) & Counter(b)).values()), len(a), len(b))


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


def expected(p, r):
    ta, tb = (re.sub("[^a-z0-9]+", " ", t.lower()).split() for t in (p, r))
    return {
        "exact_match": float(" ".join(p.lower().split()) == " ".join(r.lower().split())),
        "token_f1": bag_f(p.lower().split(), r.lower().split()),
        "rouge1_f": round(bag_f(ta, tb), 6),
        "rouge2_f": round(bag_f(list(zip(ta, ta[1:])), list(zip(tb, tb[1:]))), 6),
        "rougeL_f": round(f_score(slow_lcs(ta, tb), len(ta), len(tb)), 6),
    }


def scores(spark, pairs):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)], "i int, raw_response string, ground_truth string")
    return [r.asDict() for r in M.score_columns(df).orderBy("i").collect()]


def test_all_scores(spark):
    for pair, got in zip(PAIRS, scores(spark, PAIRS), strict=True):
        for name, value in expected(*pair).items():
            assert got[name] == pytest.approx(value, abs=1e-12), (pair, name)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(*[st.text(alphabet="abc  \nÄ1.", max_size=30)] * 2), min_size=40, max_size=40))
def test_scores_agree_with_the_direct_way(spark, pairs):
    for pair, got in zip(pairs, scores(spark, pairs), strict=True):
        for name, value in expected(*pair).items():
            assert got[name] == pytest.approx(value, abs=1e-6 if name.startswith("rouge") else 1e-12), (pair, name)


def test_edit_similarity():
    assert M.edit_similarity("tide", "diet") == 0.25 and M.edit_similarity("diet", "tide") == 0.5
    assert M.edit_similarity("", " \n") == 1.0 and M.edit_similarity("", "x") == 0.0
    assert M.edit_similarity("A  b", "a B") == 1.0
    # For a second text of 200 or more characters very frequent ones no longer start a match.
    assert M.edit_similarity("x" + "ab" * 100, "ab" * 110) == 0.0
    assert M.edit_similarity("x" + "ab" * 90, "ab" * 95) > 0.9


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40))
def test_lcs(a, b):
    assert M.lcs_length(a, b) == slow_lcs(a, b)


def test_reasoning_is_dropped_from_the_reply_only(spark):
    got = scores(spark, [("<THINK>x</THINK> yes", "yes"), ("yes", "<think>x</think>yes")])
    assert got[0]["response"] == "yes" and got[0]["exact_match"] == 1.0 and got[1]["exact_match"] == 0.0


def test_nulls_stay_null(spark):
    got = scores(spark, [(None, "x")])[0]
    assert got["exact_match"] is None and got["rougeL_f"] is None


def test_table_form_equals_row_form(spark):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(PAIRS)], "i int, p string, r string")
    table = bag_scores(df, ["i"], M.words(F.col("p")), M.words(F.col("r"))).orderBy("i").collect()
    rows = df.select("i", M.token_f1(F.col("p"), F.col("r")).alias("token_f1")).orderBy("i").collect()
    assert [r.token_f1 for r in table] == pytest.approx([r.token_f1 for r in rows], abs=1e-12)


def test_long_texts_take_linear_steps(spark):
    words = " ".join(f"w{i % 5000}" for i in range(40_000))
    df = spark.createDataFrame([(words, words + " end")], "p string, r string")
    row = df.select(M.token_f1(F.col("p"), F.col("r")).alias("f"), M.rouge_1_2(F.col("p"), F.col("r")).alias("s"), M.alignment_scores("p", "r").alias("a")).first()
    assert row.f == pytest.approx(2 * 40_000 / 80_001) and row.s.rouge2_f == pytest.approx(2 * 39_999 / 79_999, abs=1e-6)
    assert row.a.rougeL_f == pytest.approx(2 * 40_000 / 80_001, abs=1e-6)
