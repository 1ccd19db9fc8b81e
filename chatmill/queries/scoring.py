"""Text scores of replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions import metrics
from chatmill.functions.text import strip_think_blocks
from chatmill.functions.text import strip_thinking as drop_reasoning
from chatmill.operators.bags import bag_scores
from chatmill.operators.conversations import reply_pairs
from chatmill.queries.registry import Tables, query

# A reply made from an exchange, and the answer it is scored against; valid in Spark and in DuckDB.
RAW_SQL = """
CASE (conv_id + turn) % 8
  WHEN 0 THEN '<think>' || question || chr(10) || '</think>' || chr(10) || reply
  WHEN 1 THEN '<THINK>' || question || '</Think> ' || reply
  WHEN 2 THEN question
  WHEN 3 THEN '  ' || replace(reply, ' ', '  ') || chr(10)
  WHEN 4 THEN reply || ' ' || question || ' ' || question
  WHEN 5 THEN ''
  WHEN 6 THEN '<think>' || reply
  ELSE question || ' ' || reply END
"""
PAIRS_SQL = f"""
WITH pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS reply
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
raws AS (SELECT conv_id, turn, {RAW_SQL} AS raw_response, reply AS ground_truth FROM pairs),
replies AS (SELECT *, trim(regexp_replace(raw_response, '(?is)<think>.*?</think>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS response FROM raws),
norm AS (SELECT *, trim(regexp_replace(lower(response), '\\s+', ' ', 'g')) AS np, trim(regexp_replace(lower(ground_truth), '\\s+', ' ', 'g')) AS nr FROM replies),
words AS (SELECT *, list_filter(string_split(np, ' '), lambda x: x <> '') AS wp, list_filter(string_split(nr, ' '), lambda x: x <> '') AS wr,
  list_filter(string_split(regexp_replace(lower(response), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS p1,
  list_filter(string_split(regexp_replace(lower(ground_truth), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS r1 FROM norm),
grams AS (SELECT *, list_transform(range(1, len(p1)), lambda i: p1[i] || ' ' || p1[i + 1]) AS p2,
  list_transform(range(1, len(r1)), lambda i: r1[i] || ' ' || r1[i + 1]) AS r2 FROM words)
"""


def _overlap_sql(p: str, r: str) -> str:
    counts = f"lambda w: least(len(list_filter({p}, lambda x: x = w)), len(list_filter({r}, lambda x: x = w)))"
    return f"coalesce(list_sum(list_transform(list_distinct({r}), {counts})), 0)"


def _f_sql(overlap: str, p: str, r: str) -> str:
    a, b = f"({overlap} / len({p}))", f"({overlap} / len({r}))"
    return f"CASE WHEN {overlap} > 0 THEN round_even(2 * {a} * {b} / ({a} + {b}), 6) ELSE 0.0 END"


OVERLAPS_SQL = (
    PAIRS_SQL + f", scored AS (SELECT *, {_overlap_sql('wp', 'wr')} AS ow, {_overlap_sql('p1', 'r1')} AS o1, {_overlap_sql('p2', 'r2')} AS o2 FROM grams)"
)
# The longest common subsequence, a row of the usual table at a time: `acc` holds the lengths for the words of r1 so far, and the
# next row is a running maximum over the old row and the diagonal steps where words are equal.
LCS_SQL = (
    PAIRS_SQL
    + """, common AS (SELECT *, CASE WHEN len(p1) = 0 OR len(r1) = 0 THEN 0 ELSE list_max(list_reduce(
  list_prepend(list_transform(p1, lambda x: 0), list_transform(r1, lambda w: list_transform(p1, lambda x: CASE WHEN x = w THEN 1 ELSE 0 END))),
  lambda acc, m: list_transform(range(1, len(p1) + 1), lambda i: greatest(acc[i], list_max(list_transform(range(1, i + 1),
    lambda k: CASE WHEN m[k] = 1 THEN 1 + CASE WHEN k > 1 THEN acc[k - 1] ELSE 0 END ELSE 0 END)))))) END AS lcs FROM grams)
"""
)
EXACT_SQL = "CASE WHEN np = nr THEN 1.0 ELSE 0.0 END::DOUBLE"
F1_SQL, R1_SQL, R2_SQL = _f_sql("ow", "wp", "wr"), _f_sql("o1", "p1", "r1"), _f_sql("o2", "p2", "r2")


def replies(t: Tables) -> DataFrame:
    pairs = reply_pairs(t.conversations)
    return pairs.select("conv_id", "turn", F.expr(RAW_SQL).alias("raw_response"), F.col("reply").alias("ground_truth"))


def _responses(t: Tables) -> DataFrame:
    return replies(t).withColumn("response", drop_reasoning(F.col("raw_response")))


@query(
    PAIRS_SQL
    + """SELECT conv_id, turn, response,
  trim(regexp_replace(raw_response, '(?s)<think>.*?</think>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS json_side FROM replies"""
)
def strip_thinking(t: Tables):
    """The scoring variant ignores case, the JSON variant does not."""
    return _responses(t).select("conv_id", "turn", "response", strip_think_blocks(F.col("raw_response")).alias("json_side"))


@query(PAIRS_SQL + f"SELECT conv_id, turn, {EXACT_SQL} AS exact_match FROM norm")
def norm_exact_match(t: Tables):
    return _responses(t).select("conv_id", "turn", metrics.exact_match(F.col("response"), F.col("ground_truth")).alias("exact_match"))


@query(OVERLAPS_SQL + f"SELECT conv_id, turn, {F1_SQL} AS token_f1 FROM scored")
def token_f1(t: Tables):
    score = F.bround(metrics.token_f1(F.col("response"), F.col("ground_truth")), 6)
    return _responses(t).select("conv_id", "turn", score.alias("token_f1"))


@query(OVERLAPS_SQL + f"SELECT conv_id, turn, {R1_SQL} AS rouge1_f, {R2_SQL} AS rouge2_f FROM scored")
def rouge12(t: Tables):
    scored = _responses(t).withColumn("s", metrics.rouge_1_2(F.col("response"), F.col("ground_truth")))
    return scored.select("conv_id", "turn", "s.rouge1_f", "s.rouge2_f")


@query(OVERLAPS_SQL + f"SELECT conv_id, turn, CAST(ow AS BIGINT) AS overlap, {F1_SQL} AS token_f1 FROM scored")
def bag_overlap(t: Tables):
    """Token F1 by exploding tokens and counting, the form for texts too long for one row."""
    rows = _responses(t)
    scored = bag_scores(rows, ["conv_id", "turn"], metrics.words(F.col("response")), metrics.words(F.col("ground_truth")))
    return scored.withColumn("token_f1", F.bround("token_f1", 6))


@query(
    OVERLAPS_SQL
    + f"SELECT conv_id, turn, response, {EXACT_SQL} AS exact_match, {F1_SQL} AS token_f1, {R1_SQL} AS rouge1_f, {R2_SQL} AS rouge2_f FROM scored"
)
def score_all(t: Tables):
    scored = metrics.score_columns(replies(t), alignment=False)
    return scored.select("conv_id", "turn", "response", "exact_match", F.bround("token_f1", 6).alias("token_f1"), "rouge1_f", "rouge2_f")


@query(LCS_SQL + f"SELECT conv_id, turn, {_f_sql('lcs', 'p1', 'r1')} AS rougeL_f FROM common")
def rouge_l(t: Tables):
    """Longest-common-subsequence score of whole texts."""
    scored = _responses(t).withColumn("s", metrics.alignment_scores("response", "ground_truth"))
    return scored.select("conv_id", "turn", "s.rougeL_f")


@query()
def alignment_scores(t: Tables):
    """Both scores of whole texts. The matching-block similarity has no SQL and is checked against brute force in the tests."""
    scored = _responses(t).withColumn("s", metrics.alignment_scores("response", "ground_truth"))
    return scored.select("conv_id", "turn", "s.rougeL_f", F.bround("s.edit_sim", 6).alias("edit_sim"))


@query(
    PAIRS_SQL
    + """SELECT conv_id, turn, round_even(CASE WHEN greatest(length(np), length(nr)) > 0 THEN 1 - levenshtein(regexp_replace(np, '[^ -~]', '?', 'g'), regexp_replace(nr, '[^ -~]', '?', 'g')) / greatest(length(np), length(nr)) ELSE 1.0 END, 6)
  AS levenshtein_sim FROM norm"""
)
def levenshtein_sim(t: Tables):
    """With a question mark for every letter that is not ASCII, since the SQL engine counts bytes."""
    pred, ref = (F.regexp_replace(metrics.normalize(F.col(c)), "[^ -~]", "?") for c in ("response", "ground_truth"))
    score = F.bround(metrics.levenshtein_sim(pred, ref), 6)
    return _responses(t).select("conv_id", "turn", score.alias("levenshtein_sim"))


@query(
    OVERLAPS_SQL
    + f"""SELECT count(*) AS n, round_even(avg({EXACT_SQL}), 6) AS exact_match_mean, round_even(avg({F1_SQL}), 6) AS token_f1_mean,
  round_even(avg({R1_SQL}), 6) AS rouge1_f_mean, round_even(avg({R2_SQL}), 6) AS rouge2_f_mean FROM scored"""
)
def score_summary(t: Tables):
    """The flagship: pair turns, strip reasoning, score, and average, all in built-in expressions."""
    scored = metrics.score_columns(replies(t), alignment=False).withColumn("token_f1", F.bround("token_f1", 6))
    names = ("exact_match", "token_f1", "rouge1_f", "rouge2_f")
    return scored.agg(F.count(F.lit(1)).alias("n"), *[F.bround(F.avg(n), 6).alias(f"{n}_mean") for n in names])
