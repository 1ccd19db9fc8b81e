"""Documents: questions, records, splits, merges, orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.chat import render
from chatmill.functions.dates import with_notations
from chatmill.functions.options import expand_questions
from chatmill.functions.prompts import DOCUMENT_PREAMBLE
from chatmill.functions.qa import parse_qa as split_qa
from chatmill.functions.qa import qa_samples
from chatmill.operators.combine import document_counts as count_documents
from chatmill.operators.combine import merge_sources as merge
from chatmill.operators.combine import record_counts
from chatmill.operators.conversations import reply_pairs
from chatmill.operators.ordering import first_rows, number_shuffled
from chatmill.operators.pairing import orphans, pair_documents
from chatmill.operators.split import with_split
from chatmill.plans.documents import document_rejects, document_dataset, document_records, document_tasks
from chatmill.operators.staging import new_path
from chatmill.queries.registry import Tables, query
from chatmill.sources.jsonl import read_conversations
from chatmill.sources.sinks import eval_path, write_dataset


@query("""
SELECT doc_id, source, md5(text) AS text_key, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS row_no
FROM documents
""")
def seeded_shuffle(t: Tables):
    placed = number_shuffled(t.documents.select("doc_id", "source", "text"), 42, ["doc_id"])
    return placed.select("doc_id", "source", F.md5("text").alias("text_key"), "row_no")


@query("SELECT doc_id, source, lang FROM documents ORDER BY source, doc_id LIMIT 100")
def row_cap(t: Tables):
    return first_rows(t.documents.select("doc_id", "source", "lang"), ["source", "doc_id"], 100)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 12000")
def row_cap_large(t: Tables):
    """A cap above what the top-k operator should gather in one task."""
    return first_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 12_000)


def _split_sql(table: str, key: str, share: float, out: str) -> str:
    return f"""
WITH k AS (SELECT DISTINCT {key} AS grp FROM {table}),
r AS (SELECT grp, row_number() OVER (ORDER BY md5('42|' || grp), CAST(grp AS STRING)) AS place, count(*) OVER () AS n FROM k)
SELECT {out}, CASE WHEN place <= greatest(1, round_even(n * CAST({share} AS DOUBLE), 0)) THEN 'eval' ELSE 'train' END AS split
FROM {table} JOIN r ON {key} = grp"""


@query(_split_sql("documents", "source", 0.25, "doc_id, source, n_chars"))
def group_split(t: Tables):
    return with_split(t.documents.select("doc_id", "source", "n_chars"), "source", 0.25, 42)


@query(_split_sql("orders", "o_custkey", 0.1, "o_orderkey, o_custkey"))
def group_split_many(t: Tables):
    """A split over very many groups."""
    return with_split(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 0.1, 42)


def _merged(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("id"), "text", "lang")
    return merge({"documents": docs, "benchmark": t.benchmark.select(F.col("item_id").alias("id"), "text"), "again": docs})


@query("""
SELECT source, source_no, id, lang, md5(text) AS text_key FROM (
  SELECT 'documents' AS source, 0 AS source_no, doc_id AS id, lang, text FROM documents
  UNION ALL SELECT 'benchmark', 1, item_id, NULL, text FROM benchmark
  UNION ALL SELECT 'again', 2, doc_id, lang, text FROM documents)
""")
def merge_sources(t: Tables):
    return _merged(t).select("source", "source_no", "id", "lang", F.md5("text").alias("text_key"))


@query("""
SELECT coalesce(source, 'total') AS source, count(*) AS records FROM (
  SELECT 'documents' AS source FROM documents UNION ALL SELECT 'benchmark' FROM benchmark UNION ALL SELECT 'again' FROM documents)
GROUP BY ROLLUP (source)
""")
def merge_counts(t: Tables):
    return record_counts(_merged(t))


@query("SELECT doc_id, source, quality FROM documents JOIN labels USING (doc_id)")
def paired_docs(t: Tables):
    return pair_documents(t.documents.select("doc_id", "source"), t.labels.select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_docs(t: Tables):
    return orphans(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@query("""
WITH t AS (SELECT p_partkey, list_concat(string_split(p_name, ' '), ['_']) AS a, [p_brand, p_type, p_brand] AS b FROM part),
e AS (SELECT *, unnest(range(len(a) * len(b))) AS option_no FROM t),
o AS (SELECT p_partkey, option_no, a[option_no // len(b) + 1] AS x, b[option_no % len(b) + 1] AS y FROM e)
SELECT p_partkey, option_no,
       'Is the' || CASE WHEN x = '_' THEN '' ELSE ' ' || x END || ' part ' || y || '?' AS question
FROM o
""")
def expand_question_options(t: Tables):
    """Two option blocks per part; a repeated option gives a repeated question."""
    template = F.concat(
        F.lit("Is the {"), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", _} part { "), F.concat_ws(",", "p_brand", "p_type", "p_brand"), F.lit("}?")
    )
    rows = t.part.select("p_partkey", template.alias("question"))
    return expand_questions(rows).select("p_partkey", "option_no", "question")


def _qa_texts(t: Tables) -> DataFrame:
    """One Q&A text per conversation, a block per exchange; some blocks lack the prefix or the answer."""
    question = F.replace("question", F.lit("\n"), F.lit(" "))
    fault = (F.col("conv_id") + F.col("turn")) % 7
    block = F.concat(
        F.when(fault == 1, "").otherwise("> "), question, F.lit("\n\n"), F.when(fault == 3, "").otherwise(F.col("reply")), F.lit("  \n\n")
    )
    rows = reply_pairs(t.conversations).select(F.col("conv_id").alias("stem"), "turn", block.alias("block"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "block"))), lambda x: x["block"]), "--  \r\n")
    return rows.groupBy("stem").agg(joined.alias("qa_text"))


QA_SQL = """
WITH b AS (
  SELECT u.conv_id AS stem, row_number() OVER (PARTITION BY u.conv_id ORDER BY u.turn) - 1 AS block_no, (u.conv_id + u.turn) % 7 AS fault,
         replace(u.text, chr(10), ' ') AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')
"""


@query(QA_SQL + "SELECT stem, block_no, question, answer FROM b WHERE fault NOT IN (1, 3)")
def parse_qa(t: Tables):
    return split_qa(_qa_texts(t))[0]


@query(
    QA_SQL
    + """
SELECT stem, block_no, CASE fault WHEN 1 THEN question ELSE '> ' || question END AS head,
       CASE fault WHEN 1 THEN 'no question prefix' ELSE 'no answer' END AS fault
FROM b WHERE fault IN (1, 3)"""
)
def parse_qa_rejects(t: Tables):
    return split_qa(_qa_texts(t))[1]


def _docs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Documents, and Q&A texts for those of them that have a label."""
    docs = t.documents.select(F.col("doc_id").alias("stem"), F.col("text").alias("content"))
    facts = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id", "quality"), "doc_id")
    qa = F.concat(
        F.lit("> Which {language, tongue, _} is {it, the text} in?\n"), F.col("lang"),
        F.lit("\n--\n\n> Where does it come from?\n\nsource:\n\n"), F.col("source"),
        F.lit("\n--\n> Is it good?\n"), F.when(F.col("quality") == 1, "yes").otherwise(""),
    )
    return docs, facts.select(F.col("doc_id").alias("stem"), qa.alias("qa_text"))


RECORDS_SQL = f"""
q AS (
  SELECT d.doc_id AS stem, d.text AS content, o.block_no, o.option_no, o.question,
         CASE o.block_no WHEN 0 THEN d.lang WHEN 1 THEN 'source:' || chr(10) || chr(10) || d.source ELSE 'yes' END AS answer
  FROM documents d JOIN labels l USING (doc_id), (VALUES
    (0, 0, 'Which language is it in?'), (0, 1, 'Which language is the text in?'), (0, 2, 'Which tongue is it in?'),
    (0, 3, 'Which tongue is the text in?'), (0, 4, 'Which is it in?'), (0, 5, 'Which is the text in?'),
    (1, 0, 'Where does it come from?'), (2, 0, 'Is it good?')) o(block_no, option_no, question)
  WHERE o.block_no < 2 OR l.quality = 1),
r AS (SELECT *, replace('{DOCUMENT_PREAMBLE}', chr(13), '') || content AS system FROM q)
"""
RENDERED_SQL = """md5('<|im_start|>system' || chr(10) || system || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || question
 || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10))"""


@query(f"WITH {RECORDS_SQL} SELECT stem, block_no, option_no, {RENDERED_SQL} AS record_key FROM r")
def docs_records(t: Tables):
    records = document_records(*_docs(t))
    return records.select("stem", "block_no", "option_no", F.md5(render(F.col("conversations"))).alias("record_key"))


@query(f"""
WITH {RECORDS_SQL},
k AS (SELECT stem, row_number() OVER (ORDER BY md5('42|' || stem), CAST(stem AS STRING)) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT doc_id AS stem FROM labels)),
s AS (SELECT stem, CASE WHEN place <= greatest(1, round_even(n * CAST(0.2 AS DOUBLE), 0)) THEN 'eval' ELSE 'train' END AS split FROM k)
SELECT stem, block_no, option_no, split, {RENDERED_SQL} AS record_key FROM r JOIN s USING (stem)
""")
def docs_train_eval(t: Tables):
    """The whole job: pairing, split by document, expansion and the shuffle of the train side."""
    train, evaluation = document_dataset(*_docs(t), share=0.2, seed=42)
    both = train.withColumn("split", F.lit("train")).unionByName(evaluation.withColumn("split", F.lit("eval")))
    return both.select("stem", "block_no", "option_no", "split", F.md5(render(F.col("conversations"))).alias("record_key"))


@query(f"""
WITH {RECORDS_SQL},
k AS (SELECT stem, row_number() OVER (ORDER BY md5('42|' || stem), CAST(stem AS STRING)) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT doc_id AS stem FROM labels)),
s AS (SELECT stem, CASE WHEN place <= greatest(1, round_even(n * CAST(0.2 AS DOUBLE), 0)) THEN 'eval' ELSE 'train' END AS split FROM k)
SELECT split, {RENDERED_SQL} AS record_key FROM r JOIN s USING (stem)
""")
def split_sink(t: Tables):
    """Both sides written as files and read back, after a later write with an empty side was refused and left them as they were."""
    path = f"{new_path(t.spark, 'split')}/train.jsonl"
    train, evaluation = document_dataset(*_docs(t), share=0.2, seed=42)
    counts = {r["side"]: r["records"] for r in write_dataset(train, evaluation, path).collect()}
    assert counts == {r["side"]: r["records"] for r in write_dataset(train, evaluation, path, dry=True).collect()}
    try:
        write_dataset(train.limit(1), evaluation.limit(0), path)
    except ValueError:
        pass
    sides = {"train": path, "eval": eval_path(path)}
    both = reduce(DataFrame.unionByName, [read_conversations(t.spark, p).select(F.lit(side).alias("split"), F.md5(render(F.col("conversations"))).alias("record_key")) for side, p in sides.items()])
    return both


@query(f"""
WITH {RECORDS_SQL}
SELECT stem AS doc, question, answer AS ground_truth, md5(system) AS system_key FROM r ORDER BY stem, block_no, option_no LIMIT 300
""")
def docs_tasks(t: Tables):
    tasks = document_tasks(*_docs(t), max_samples=300)
    return tasks.select("doc", "question", "ground_truth", F.md5("system").alias("system_key"))


@query("""
SELECT doc_id AS stem, CASE WHEN l.doc_id IS NULL THEN NULL ELSE b END AS block_no, CASE WHEN l.doc_id IS NULL THEN 'no Q&A text' ELSE f END AS fault
FROM documents d LEFT JOIN labels l USING (doc_id), (VALUES (1, 'no question prefix'), (3, 'no answer')) x(b, f)
WHERE l.doc_id IS NOT NULL OR b = 1
""")
def docs_rejects(t: Tables):
    """Faulty blocks, and documents without a Q&A text."""
    qa = t.labels.select(F.col("doc_id").alias("stem"), F.lit("> Is it?\nyes\n--\nno prefix\nx\n--\n> And?\nno\n--\n> Unanswered?\n--\n").alias("qa_text"))
    docs = t.documents.select(F.col("doc_id").alias("stem"), F.col("text").alias("content"))
    return document_rejects(docs, qa).select("stem", "block_no", "fault")


@query(f"WITH {RECORDS_SQL} SELECT stem, count(DISTINCT block_no) AS raw, count(*) AS expanded FROM r GROUP BY stem")
def document_counts(t: Tables):
    return count_documents(qa_samples(_docs(t)[1]))


DATE_SQL = """
CASE o_orderkey % 8
  WHEN 0 THEN CAST(day(o_orderdate) AS STRING) || '.' || CAST(month(o_orderdate) AS STRING) || '.' || CAST(year(o_orderdate) AS STRING)
  WHEN 1 THEN '  ' || {padded} || ' '
  WHEN 2 THEN substr({padded}, 1, 6) || substr({padded}, 9, 2)
  WHEN 3 THEN '31.02.' || CAST(year(o_orderdate) AS STRING)
  WHEN 4 THEN 'unknown'
  WHEN 5 THEN NULL
  ELSE {padded} END
""".format(
    padded="(lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '.' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '.' || CAST(year(o_orderdate) AS STRING))"
)


@query(f"""
WITH v AS (SELECT o_orderkey, o_orderdate AS d, {DATE_SQL} AS value, o_orderkey % 8 IN (0, 1, 6, 7) AS good FROM orders),
m AS (SELECT *, ['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober', 'November', 'Dezember'][month(d)] AS mon FROM v)
SELECT o_orderkey, value,
       CASE WHEN good THEN strftime(d, '%d.%m.%Y') ELSE value END AS fmt_0,
       CASE WHEN good THEN strftime(d, '%Y-%m-%d') ELSE value END AS fmt_1,
       CASE WHEN good THEN strftime(d, '%d/%m/%Y') ELSE value END AS fmt_2,
       CASE WHEN good THEN strftime(d, '%m/%d/%Y') ELSE value END AS fmt_3,
       CASE WHEN good THEN day(d) || '. ' || mon || ' ' || year(d) ELSE value END AS fmt_4,
       CASE WHEN good THEN strftime(d, '%B %d, %Y') ELSE value END AS fmt_5
FROM m
""")
def date_formats(t: Tables):
    rows = t.orders.select("o_orderkey", F.expr(DATE_SQL).alias("value"))
    return with_notations(rows, "value", [f"fmt_{i}" for i in range(6)])
