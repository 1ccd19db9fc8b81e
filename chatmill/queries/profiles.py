"""Structured samples: pairing, validation, variants, prompts, targets, repair, field scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.chat import render
from chatmill.functions.dates import DATE_LABELS
from chatmill.functions.fields import score_fields
from chatmill.functions.prompts import SchemaWording
from chatmill.functions.prompts import schema_prompt as prompt_column
from chatmill.functions.repair import parse_reply
from chatmill.functions.targets import read_targets, target_faults, with_ordered_target
from chatmill.operators.augment import with_variants
from chatmill.operators.pairing import pair_folders
from chatmill.operators.report import field_table, profile_summary
from chatmill.operators.split import with_split
from chatmill.operators.staging import spread
from chatmill.plans.profiles import folder_tasks, valid_samples, variant_records
from chatmill.queries.registry import Tables, query
from chatmill.schemas import PROFILE_FIELDS

NAMES = [f.name for f in PROFILE_FIELDS]

# A target object per customer, as text; valid in Spark and in DuckDB.
BIRTH_SQL = "(lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || '.' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '.' || CAST(1950 + c_custkey % 50 AS STRING))"
VALUES_SQL = {
    "name": "'\"' || c_name || '\"'",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN '\"female\"' ELSE 'null' END",
    "email": "'\"c' || CAST(c_custkey AS STRING) || '@example.com\"'",
    "address": "'\"Straße ' || CAST(c_custkey AS STRING) || '/a\"'",
    "date_of_birth": f"CASE WHEN c_custkey % 10 = 9 THEN '\"' || c_mktsegment || '\"' ELSE '\"' || {BIRTH_SQL} || '\"' END",
    "nationality": "'\"' || n_name || '\"'",
    "languages": "'[\"Deutsch C1\",\"' || n_name || ' B2\"]'",
    "education": "'[]'",
    "skills": "'[\"' || c_mktsegment || '\"]'",
    "products": "'[\"P' || CAST(c_nationkey AS STRING) || '\",\"Ü\"]'",
}


def _pair(field: str, value: str | None = None) -> str:
    return f"'\"{field}\":' || {value or VALUES_SQL[field]}"


TARGET_SQL = "'{' || " + " || ',' || ".join(map(_pair, VALUES_SQL)) + " || '}'"


def _with(*changes: tuple[str, str]) -> str:
    """The target with new values for some fields."""
    out = "target"
    for field, value in changes:
        out = f"replace({out}, {_pair(field)}, {_pair(field, value)})"
    return out


FAULTY_SQL = f"""
CASE c_custkey % 9
  WHEN 1 THEN replace(target, {_pair("languages")} || ',', '')
  WHEN 2 THEN {_with(("education", "'null'"))}
  WHEN 3 THEN {_with(("skills", "'\"' || c_mktsegment || '\"'"))}
  WHEN 4 THEN {_with(("nationality", "'5'"))}
  WHEN 5 THEN substr(target, 1, length(target) - 1) || ',"zip":"1"}}'
  WHEN 6 THEN '[' || target || ']'
  WHEN 7 THEN substr(target, 1, 100)
  WHEN 8 THEN target || ' end'
  ELSE target END
"""
BASE_SQL = f"FROM (SELECT *, {TARGET_SQL} AS target FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _customers(t: Tables, **texts: str) -> DataFrame:
    rows = spread(t.customer).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("target", F.expr(TARGET_SQL))
    return rows.select("c_custkey", "c_nationkey", "c_mktsegment", *[F.expr(sql).alias(name) for name, sql in texts.items()])


def folders(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejects): documents as texts and customers as objects; one market segment has no object files."""
    texts = t.documents.select(F.lit("").alias("lang"), F.col("doc_id").alias("sample"), F.lit("cv.md").alias("file"), F.col("text").alias("cv_text"))
    second = texts.filter(F.col("sample") % 4 == 0).withColumns({"file": F.lit("old.md"), "cv_text": F.lit("not used")})
    objects = _customers(t, json_text=FAULTY_SQL).filter(F.col("c_mktsegment") != "MACHINERY")
    objects = objects.select(F.lit("").alias("lang"), F.col("c_custkey").alias("sample"), F.lit("cv.json").alias("file"), "json_text")
    return pair_folders(texts.unionByName(second), objects, ["lang", "sample"])


FOLDER_SQL = f"""
o AS (SELECT c_custkey, c_nationkey, c_name, c_mktsegment, n_name, {FAULTY_SQL} AS json_text {BASE_SQL} WHERE c_mktsegment <> 'MACHINERY')
"""


@query(f"""
WITH {FOLDER_SQL}
SELECT doc_id AS sample, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS text_key, json_text,
       CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS text_files
FROM documents JOIN o ON doc_id = c_custkey
""")
def folder_pairs(t: Tables):
    return folders(t)[0].select("sample", F.md5("cv_text").alias("text_key"), "json_text", "text_files")


@query(f"""
WITH {FOLDER_SQL}
SELECT coalesce(doc_id, c_custkey) AS sample, CASE WHEN doc_id IS NULL THEN 'no text file' ELSE 'no json file' END AS fault
FROM documents FULL JOIN o ON doc_id = c_custkey WHERE doc_id IS NULL OR c_custkey IS NULL
""")
def folder_rejects(t: Tables):
    return folders(t)[1].select("sample", "fault")


@query(f"""
WITH o AS (SELECT c_custkey, {FAULTY_SQL} AS json_text {BASE_SQL})
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE 1 END AS faults,
       CASE c_custkey % 9 WHEN 1 THEN 'languages' WHEN 2 THEN 'education' WHEN 3 THEN 'skills' WHEN 4 THEN 'nationality' WHEN 5 THEN 'zip' END AS field,
       CASE c_custkey % 9 WHEN 1 THEN 'missing' WHEN 2 THEN 'not a list' WHEN 3 THEN 'not a list' WHEN 4 THEN 'not a string' WHEN 5 THEN 'unexpected'
         WHEN 6 THEN 'not an object' WHEN 7 THEN 'unreadable' WHEN 8 THEN 'unreadable' END AS fault
FROM o
""")
def validate_records(t: Tables):
    checked = _customers(t, json_text=FAULTY_SQL).withColumn("f", target_faults(F.col("json_text")))
    first = F.get("f", F.lit(0))
    return checked.select("c_custkey", F.size("f").alias("faults"), first["field"].alias("field"), first["fault"].alias("fault"))


ORDER_SQL = f"""
v AS (SELECT *, unnest(range(4)) AS variant {BASE_SQL}),
h AS (SELECT *, list_transform(list_sort(list_transform({NAMES!r}, lambda f: md5('42|' || c_custkey || '|' || variant || '|' || f) || f)), lambda x: substr(x, 33)) AS mixed,
  CAST('0x' || substr(md5('42|' || c_custkey || '|' || variant || '|date'), 1, 8) AS BIGINT) % 5 + 1 AS other FROM v),
w AS (SELECT *, CASE WHEN variant = 0 THEN {NAMES!r} ELSE mixed END AS field_order, CASE WHEN variant = 0 THEN 0 ELSE other END AS date_fmt FROM h)
"""


@query(f"WITH {ORDER_SQL} SELECT c_custkey, variant, array_to_string(field_order, ',') AS field_order, date_fmt FROM w")
def augment_fields(t: Tables):
    rows = with_variants(spread(t.customer.select("c_custkey")), "c_custkey", 3, 42)
    return rows.select("c_custkey", "variant", F.array_join("field_order", ",").alias("field_order"), "date_fmt")


@query("""
WITH r AS (SELECT grp, row_number() OVER (ORDER BY md5('42|' || grp), CAST(grp AS STRING)) AS place, count(*) OVER () AS n
           FROM (SELECT DISTINCT c_nationkey AS grp FROM customer))
SELECT c_custkey, split, unnest(range(CASE split WHEN 'train' THEN 3 ELSE 1 END)) AS variant FROM (
  SELECT c_custkey, CASE WHEN place <= greatest(1, round_even(n * CAST(0.3 AS DOUBLE), 0)) THEN 'eval' ELSE 'train' END AS split
  FROM customer JOIN r ON c_nationkey = grp)
""")
def augment_train_only(t: Tables):
    rows = with_split(spread(t.customer.select("c_custkey", "c_nationkey")), "c_nationkey", 0.3, 42)
    rows = with_variants(rows, "c_custkey", F.when(F.col("split") == "train", 2).otherwise(0), 42)
    return rows.select("c_custkey", "split", "variant")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDING = SchemaWording()
_LINE_CASES = " ".join(f"WHEN '{f.name}' THEN {_sql_text(f'  {f.name:<15}– {f.description}')}" for f in PROFILE_FIELDS)
PROMPT_SQL = f"""replace({_sql_text(_WORDING.intro)} || chr(10) || chr(10)
  || array_to_string(list_transform(field_order, lambda f: CASE f {_LINE_CASES} END), chr(10)) || chr(10) || chr(10)
  || {' || chr(10) || '.join(map(_sql_text, _WORDING.rules))} || chr(10), '{{date}}', {list(DATE_LABELS)!r}[date_fmt + 1])"""


@query(f"WITH {ORDER_SQL} SELECT c_custkey, variant, {PROMPT_SQL} AS prompt FROM w")
def schema_prompt(t: Tables):
    rows = with_variants(spread(t.customer.select("c_custkey")), "c_custkey", 3, 42)
    return rows.select("c_custkey", "variant", prompt_column(F.col("field_order"), F.col("date_fmt")).alias("prompt"))


_MONTHS = "['Januar', 'Februar', 'März', 'April', 'Mai', 'Juni', 'Juli', 'August', 'September', 'Oktober', 'November', 'Dezember']"
_TARGET_VALUES = VALUES_SQL | {
    "date_of_birth": "CASE WHEN c_custkey % 10 = 9 THEN '\"' || c_mktsegment || '\"' ELSE '\"' || CASE date_fmt WHEN 0 THEN birth WHEN 1 THEN strftime(day, '%Y-%m-%d')"
    " WHEN 2 THEN strftime(day, '%d/%m/%Y') WHEN 3 THEN strftime(day, '%m/%d/%Y')"
    f" WHEN 4 THEN day(day) || '. ' || {_MONTHS}[month(day)] || ' ' || year(day) ELSE strftime(day, '%B %d, %Y') END || '\"' END",
    "languages": "'[' || chr(10) || '    \"Deutsch C1\",' || chr(10) || '    \"' || n_name || ' B2\"' || chr(10) || '  ]'",
    "skills": "'[' || chr(10) || '    \"' || c_mktsegment || '\"' || chr(10) || '  ]'",
    "products": "'[' || chr(10) || '    \"P' || c_nationkey || '\",' || chr(10) || '    \"Ü\"' || chr(10) || '  ]'",
}
_VALUE_CASES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _TARGET_VALUES.items())
PRETTY_SQL = (
    f"'{{' || chr(10) || array_to_string(list_transform(field_order, lambda f: '  \"' || f || '\": ' || CASE f {_VALUE_CASES} END), ',' || chr(10)) || chr(10) || '}}'"
)
DAYS_SQL = f"d AS (SELECT *, {BIRTH_SQL} AS birth, strptime({BIRTH_SQL}, '%d.%m.%Y') AS day FROM w)"


@query(f"WITH {ORDER_SQL}, {DAYS_SQL} SELECT c_custkey, variant, {PRETTY_SQL} AS target FROM d")
def ordered_json(t: Tables):
    rows = with_variants(read_targets(_customers(t, json_text="target"), "json_text"), "c_custkey", 3, 42)
    rows = with_ordered_target(rows, "json_text", F.col("field_order"), F.col("date_fmt"))
    return rows.select("c_custkey", "variant", "target")


@query(f"""
WITH {ORDER_SQL}, {DAYS_SQL}, p AS (SELECT *, {PROMPT_SQL} AS prompt, {PRETTY_SQL} AS pretty FROM d)
SELECT doc_id AS sample, variant, md5('<|im_start|>system' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
  || trim(text, ' ' || chr(9) || chr(10) || chr(13)) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || pretty || '<|im_end|>' || chr(10)) AS record_key
FROM documents JOIN p ON doc_id = c_custkey WHERE c_custkey % 9 = 0 AND c_mktsegment <> 'MACHINERY'
""")
def cv_records(t: Tables):
    """Folder pairs, validation, variants, prompt and target as whole records."""
    records = variant_records(valid_samples(folders(t)[0])[0], 3, 42)
    return records.select("sample", "variant", F.md5(render(F.col("conversations"))).alias("record_key"))


@query(f"""
WITH {FOLDER_SQL}
SELECT doc_id AS sample, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS text_key, json_text AS ground_truth
FROM documents JOIN o ON doc_id = c_custkey WHERE c_custkey % 9 NOT IN (7, 8)
""")
def cv_tasks(t: Tables):
    return folder_tasks(folders(t)[0]).select("sample", F.md5("question").alias("text_key"), "ground_truth")


REPLY_SQL = f"""
CASE c_custkey % 10
  WHEN 0 THEN target
  WHEN 1 THEN '```json' || chr(10) || target || chr(10) || '```'
  WHEN 2 THEN '<think>{{"name": 1}}</think>' || chr(10) || '~~~' || chr(10) || target || chr(10) || '~~~'
  WHEN 3 THEN 'Here it is: ' || target || ' Done }}.'
  WHEN 4 THEN replace(target, '"]', '",]')
  WHEN 5 THEN replace({_with(("languages", "'[]'"), ("skills", "'[]'"), ("products", "'[]'"))}, '"', chr(39))
  WHEN 6 THEN substr(target, 1, length(target) - 2)
  WHEN 7 THEN 'I cannot read ' || c_name
  WHEN 8 THEN '[' || target
  ELSE substr(target, 1, 40) END
"""


@query(f"""
SELECT c_custkey,
  CASE c_custkey % 10 WHEN 0 THEN 'direct' WHEN 1 THEN 'direct' WHEN 2 THEN 'direct' WHEN 3 THEN 'object' WHEN 4 THEN 'commas'
    WHEN 5 THEN 'quotes' WHEN 6 THEN 'brackets' WHEN 8 THEN 'object' END AS strategy,
  CASE WHEN c_custkey % 10 IN (7, 9) THEN NULL ELSE c_name END AS name,
  CASE WHEN c_custkey % 10 IN (5, 7, 9) THEN NULL ELSE c_mktsegment END AS skill,
  CASE WHEN c_custkey % 10 IN (5, 7, 9) THEN NULL ELSE 'Ü' END AS product
{BASE_SQL}
""")
def repair_json(t: Tables):
    read = _customers(t, raw=REPLY_SQL).withColumn("r", parse_reply(F.col("raw")))
    parts = {"name": "$.name", "skill": "$.skills[0]", "product": "$.products[1]"}
    return read.select("c_custkey", "r.strategy", *[F.get_json_object("r.json", path).alias(name) for name, path in parts.items()])


# Replies with known edits per field; valid in Spark and in DuckDB.
EDITED_SQL = f"""
CASE c_custkey % 8
  WHEN 1 THEN 'no object'
  WHEN 2 THEN replace({_with(("name", "'\"  ' || c_name || ' \"'"), ("nationality", "'\"' || lower(n_name) || '\"'"))}, {_pair("gender")} || ',', '')
  WHEN 3 THEN {_with(("languages", "'[\"' || lower(n_name) || ' b2\",\" deutsch c1\"]'"), ("education", "'null'"))}
  WHEN 4 THEN {_with(("email", "'5'"), ("products", "'\"Ü\"'"))}
  WHEN 5 THEN {_with(("skills", "'[\"' || c_mktsegment || '\",\"' || c_mktsegment || '\"]'"), ("address", "'null'"))}
  ELSE target END
"""


def _same_sql(field: str) -> str:
    wrong = {"education": "k = 3", "email": "k = 4", "products": "k = 4", "skills": "k = 5", "address": "k = 5", "gender": "k = 2 AND c_custkey % 2 = 0"}
    missed = "c_custkey % 2 = 1" if field == "gender" else "FALSE"
    return f"CASE WHEN k = 1 THEN {missed} ELSE NOT ({wrong.get(field, 'FALSE')}) END"


FLAGS_SQL = ", ".join(f"{_same_sql(n)} AS field_{n}" for n in NAMES)
MATCHED_SQL = " + ".join(f"CAST(field_{n} AS INTEGER)" for n in NAMES)
SCORED_SQL = f"""
WITH k AS (SELECT c_custkey, c_custkey % 8 AS k {BASE_SQL}),
f AS (SELECT c_custkey, k, {FLAGS_SQL} FROM k),
s AS (SELECT *, CASE WHEN k = 1 THEN 'parse_error' ELSE 'ok' END AS status, {MATCHED_SQL} AS fields_matched FROM f)
"""


def _scored(t: Tables) -> DataFrame:
    return score_fields(_customers(t, raw_response=EDITED_SQL, ground_truth="target"))


@query(
    SCORED_SQL
    + f"SELECT c_custkey, status, {', '.join(f'field_{n}' for n in NAMES)}, fields_matched, 10 AS fields_total, round_even(fields_matched / 10, 4) AS field_accuracy FROM s"
)
def compare_fields(t: Tables):
    return _scored(t).select("c_custkey", "status", *[f"field_{n}" for n in NAMES], "fields_matched", "fields_total", "field_accuracy")


_SHARE = "round_even(avg(CASE WHEN status = 'ok' THEN CAST(field_{0} AS INTEGER) END), 6)"


@query(
    SCORED_SQL
    + f"""SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'ok') AS n_ok, count(*) FILTER (WHERE status <> 'ok') AS n_error,
  round_even(avg(fields_matched / 10) FILTER (WHERE status = 'ok'), 6) AS field_accuracy_mean,
  {', '.join(_SHARE.format(n) + f' AS field_{n}_accuracy' for n in NAMES)} FROM s"""
)
def cv_summary(t: Tables):
    return profile_summary(_scored(t))


@query(
    SCORED_SQL
    + f", u AS ({' UNION ALL '.join(f'''SELECT '{n}' AS field, {_SHARE.format(n)} AS accuracy FROM s''' for n in NAMES)})"
    + " SELECT field, accuracy, repeat('█', CAST(round_even(accuracy * 20, 0) AS INTEGER)) AS bar FROM u"
)
def field_bars(t: Tables):
    return field_table(profile_summary(_scored(t)))
