"""Files: folders of documents and samples, checkpoints, prepared datasets; written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatmill.functions.chat import render, render_batch
from chatmill.operators.conversations import nest_turns
from chatmill.operators.ordering import seeded_shuffle
from chatmill.operators.staging import new_path
from chatmill.plans.evaluation import profile_tasks
from chatmill.plans.profiles import profile_rejects
from chatmill.queries.conversations import CHAT_SQL, jsonl_file
from chatmill.queries.profiles import FOLDER_SQL, folders
from chatmill.queries.registry import Tables, query
from chatmill.queries.trainlog import ENTRY_COLUMNS
from chatmill.sources.files import path_exists
from chatmill.sources.folders import LANGUAGES, read_documents, read_sample_folders
from chatmill.sources.jsonl import load_train_eval, read_lines
from chatmill.sources.logs import read_checkpoint_history
from chatmill.sources.sinks import write_files, write_lines
from chatmill.sources.small_files import empty_files

# A file or a folder takes whole blocks of disk. Samples whose tree would be larger than TREE_BYTES go through several trees, one after the other; MOST_TREES at most, as each is a pass over the table.
BLOCK, TREE_BYTES, MOST_TREES = 4096, 256 << 20, 16

UNIX_SQL = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"


@query(f"""
SELECT CAST(d.doc_id AS VARCHAR) AS name, md5({UNIX_SQL}) AS text_key, CASE WHEN l.doc_id IS NOT NULL THEN 'q ' || d.doc_id END AS qa
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def folder_documents(t: Tables):
    """Every document as a file of its own, some with a text beside it; names of every fifth begin with an underscore, of every seventh with a point."""
    folder = new_path(t.spark, "documents")
    mark = F.when(F.col("doc_id") % 5 == 0, "_").when(F.col("doc_id") % 7 == 0, ".").otherwise("")
    named = F.concat(mark, F.col("doc_id").cast("string"))
    write_files(t.documents.select(F.concat(named, F.lit(".md")).alias("path"), "text"), folder)
    qa = t.labels.join(t.documents.select("doc_id"), "doc_id")
    write_files(qa.select(F.concat(named, F.lit(".txt")).alias("path"), F.concat(F.lit("q "), "doc_id").alias("text")), folder)
    docs, texts = read_documents(t.spark, folder)
    both = docs.join(texts, "stem", "left")
    return both.select(F.regexp_replace("stem", "^[_.]", "").alias("name"), F.md5("content").alias("text_key"), F.col("qa_text").alias("qa"))


@query("""
SELECT CASE lang WHEN 'de' THEN 'de' ELSE 'en' END AS lang, CAST(doc_id AS VARCHAR) AS name, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS text_key, '{"id": ' || doc_id || '}' AS json_text
FROM documents WHERE doc_id % 11 <> 3
""")
def folder_samples(t: Tables):
    """A folder per document in one of two language folders, with a target and a description beside the text; some folders are hidden ones, some lack the target.

    A large table goes through several trees, a document's folder in the one that its key falls to: a tree is read, and its files emptied, before the next is written.
    """
    lang = F.when(F.col("lang") == "de", "de").otherwise("en")
    place = F.concat_ws("/", lang, F.concat(F.when(F.col("doc_id") % 6 == 0, ".").otherwise(""), F.col("doc_id").cast("string")))
    target = F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit("}"))
    files = F.array(
        F.struct(F.concat(place, F.lit("/cv.md")).alias("path"), F.col("text").alias("text")),
        F.struct(F.concat(place, F.lit("/cv_metadata.json")).alias("path"), F.lit("{}").alias("text")),
        F.when(F.col("doc_id") % 11 != 3, F.struct(F.concat(place, F.when(F.col("doc_id") % 4 == 0, "/_cv.json").otherwise("/cv.json")).alias("path"), target.alias("text"))),
    )
    found = new_path(t.spark, "sample-pairs")
    size = t.documents.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 4 * BLOCK)).first()[0] or 0
    trees = max(1, min(MOST_TREES, -(-size // TREE_BYTES)))
    for n in range(trees):
        root = new_path(t.spark, "samples")
        some = t.documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(trees)) == n)
        write_files(some.select(F.explode(F.array_compact(files)).alias("f")).select("f.*"), root)
        langs = [f"{root}/{name}" for name in LANGUAGES if path_exists(t.spark, f"{root}/{name}")]
        if trees > 1 and not langs:
            continue
        pairs, _ = read_sample_folders(t.spark, root)
        pairs = pairs.select("lang", F.regexp_replace("sample", "^[.]", "").alias("name"), F.md5("cv_text").alias("text_key"), "json_text")
        pairs.write.mode("append").parquet(found)
        empty_files(t.spark, langs)
    return t.spark.read.schema(pairs.schema).parquet(found)


@query(
    "WITH c AS (SELECT *, CAST(floor(event_id / 900) AS BIGINT) AS checkpoint FROM events)\nSELECT "
    + ", ".join(f"{v} AS {k}" for k, v in ENTRY_COLUMNS.items())
    + " FROM c WHERE checkpoint = (SELECT max(checkpoint) FROM c)"
)
def checkpoint_history(t: Tables):
    """Log entries in a state file per checkpoint, the one of the highest number read back; a folder whose name has no number is passed over."""
    folder = new_path(t.spark, "checkpoints")
    entries = t.events.select(F.floor(F.col("event_id") / 900).alias("n"), *[F.expr(v).cast("bigint" if "step" in k else "double").alias(k) for k, v in ENTRY_COLUMNS.items()])
    state = F.to_json(F.struct(F.collect_list(F.struct(*ENTRY_COLUMNS)).alias("log_history")))
    files = entries.groupBy("n").agg(state.alias("text")).select(F.concat(F.lit("checkpoint-"), "n", F.lit("/trainer_state.json")).alias("path"), "text")
    write_files(files, folder)
    write_files(files.limit(1).withColumn("path", F.lit("checkpoint-last/trainer_state.json")), folder)
    return read_checkpoint_history(t.spark, folder).select(*ENTRY_COLUMNS)


@query(f"SELECT row_number() OVER (ORDER BY conv_id) <= 50 AS first_50, {CHAT_SQL} AS text, {CHAT_SQL} AS again FROM conversations GROUP BY conv_id")
def train_eval_files(t: Tables):
    """Prepared records loaded without a cap as train and with one as eval, which are the first in file order; rendered alone and as a list of one."""
    path = jsonl_file(t)
    train, nothing = load_train_eval(t.spark, path, f"{path}-missing")
    assert nothing is None
    capped, _ = load_train_eval(t.spark, path, max_samples=50)
    first = capped.select(F.col("seq").alias("s"), F.col("file").alias("f"))
    marked = train.join(first, (F.col("file") == F.col("f")) & (F.col("seq") == F.col("s")), "left")
    return marked.select(F.col("s").isNotNull().alias("first_50"), render(F.col("conversations")).alias("text"), render_batch(F.array("conversations"))[0].alias("again"))


@query("""
SELECT 'records' AS source, question, ground_truth FROM (
  SELECT coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS question, '{}' AS ground_truth FROM conversations GROUP BY conv_id)
UNION ALL SELECT 'folder', trim(text, ' ' || chr(9) || chr(10) || chr(13)), '{"id": ' || doc_id || '}' FROM documents WHERE doc_id % 3 = 0
""")
def task_sources(t: Tables):
    """Evaluation tasks from a folder tree and from prepared records, of one form."""
    root = new_path(t.spark, "task-folders")
    some = t.documents.filter("doc_id % 3 = 0")
    for suffix, text in (("md", F.col("text")), ("json", F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit("}")))):
        write_files(some.select(F.concat(F.col("doc_id").cast("string"), F.lit(f"/x.{suffix}")).alias("path"), text.alias("text")), root)
    records = profile_tasks(t.spark, records=jsonl_file(t)).withColumn("source", F.lit("records"))
    tasks = records.unionByName(profile_tasks(t.spark, folder=root).withColumn("source", F.lit("folder")))
    return tasks.select("source", "question", "ground_truth")


@query("""
SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS place FROM documents
""")
def ordered_read_back(t: Tables):
    """Shuffled rows written as lines and read back: the order of the lines, through all files, is the order they were written in."""
    path = new_path(t.spark, "ordered")
    shuffled = seeded_shuffle(t.documents.select("doc_id"), 7, ["doc_id"], partitions=6)
    write_lines(shuffled.select(F.col("doc_id").cast("string").alias("line")), path)
    lines = read_lines(t.spark, path, number=True)
    sizes = lines.groupBy(F.col("file").alias("of")).agg(F.max("line_no").alias("n"))
    above = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("of", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    return lines.join(earlier, F.col("file") == F.col("of")).select(F.col("line").cast("long").alias("doc_id"), (F.col("before") + F.col("line_no")).alias("place"))


@query(f"""
WITH {FOLDER_SQL}, p AS (SELECT c_custkey, n_name FROM o JOIN documents ON doc_id = c_custkey)
SELECT c_custkey AS sample, CASE c_custkey % 9 WHEN 1 THEN 'languages' WHEN 2 THEN 'education' WHEN 3 THEN 'skills' WHEN 4 THEN 'nationality' WHEN 5 THEN 'zip' END AS field,
  CASE c_custkey % 9 WHEN 1 THEN 'missing' WHEN 2 THEN 'not a list' WHEN 3 THEN 'not a list' WHEN 4 THEN 'not a string' WHEN 5 THEN 'unexpected'
    WHEN 6 THEN 'not an object' ELSE 'unreadable' END AS fault FROM p WHERE c_custkey % 9 <> 0
UNION ALL SELECT coalesce(doc_id, c_custkey), NULL, CASE WHEN doc_id IS NULL THEN 'no text file' ELSE 'no json file' END
FROM documents FULL JOIN o ON doc_id = c_custkey WHERE doc_id IS NULL OR c_custkey IS NULL
""")
def cv_rejects(t: Tables):
    """What the job of structured samples leaves out, and why."""
    return profile_rejects(*folders(t)).select("sample", "field", "fault")

