"""Conversation records: nesting, rendering, modality, tasks, JSON lines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatmill.functions.chat import is_multimodal, render
from chatmill.operators.conversations import last_turns, multimodal_route, nest_turns, unnest_turns
from chatmill.operators.ordering import number_samples
from chatmill.operators.staging import new_path
from chatmill.plans.profiles import conversation_tasks
from chatmill.queries.registry import Tables, query
from chatmill.schemas import PART
from chatmill.sources.jsonl import read_conversations, read_lines, read_tolerant
from chatmill.sources.sinks import conversation_line, write_lines

LINE_SQL = """'{"conversations": [' || string_agg('{"role": "' || role || '", "content": ' || to_json(text) || '}', ', ' ORDER BY turn) || ']}'"""
CHAT_SQL = "string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)"


@query("""
SELECT conv_id,
       coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS question,
       coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '{}') AS ground_truth
FROM conversations GROUP BY conv_id
""")
def last_turn_pairs(t: Tables):
    return last_turns(t.conversations)


@query("""
SELECT conv_id, 'sample_' || (row_number() OVER (ORDER BY conv_id) - 1) AS sample, question FROM (
  SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS question
  FROM conversations GROUP BY conv_id)
""")
def sample_names(t: Tables):
    return number_samples(last_turns(t.conversations), ["conv_id"]).select("conv_id", "sample", "question")


@query(f"SELECT conv_id, count(*) AS turns, {LINE_SQL} AS line FROM conversations GROUP BY conv_id")
def nest_conversations(t: Tables):
    nested = nest_turns(t.conversations)
    return nested.select("conv_id", F.size("conversations").cast("bigint").alias("turns"), conversation_line(F.col("conversations")).alias("line"))


@query("SELECT conv_id, turn, role, text AS content FROM conversations")
def unnest_conversations(t: Tables):
    return unnest_turns(nest_turns(t.conversations)).select("conv_id", "turn", "role", "content")


@query(f"SELECT conv_id, {CHAT_SQL} || '<|im_start|>assistant' || chr(10) AS text FROM conversations GROUP BY conv_id")
def render_chat(t: Tables):
    return nest_turns(t.conversations).select("conv_id", render(F.col("conversations"), add_generation_prompt=True).alias("text"))


def _with_parts(t: Tables):
    """User turns that span several lines become an image part and a text part."""
    image = F.struct(F.lit("image").alias("type"), F.concat(F.lit("img/"), F.col("conv_id").cast("string"), F.lit(".png")).alias("image"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("json"))
    text = F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("image"), F.col("text").alias("text"), F.lit(None).cast("string").alias("json"))
    seen = (F.col("role") == "user") & F.col("text").contains("\n")
    parts = F.when(seen, F.array(image, text).cast(f"array<{PART.simpleString()}>"))
    return nest_turns(t.conversations.withColumns({"parts": parts, "text": F.when(~seen, F.col("text"))}))


@query("""
SELECT conv_id, bool_or(seen) AS multimodal,
       string_agg('<|im_start|>' || role || chr(10) || CASE WHEN seen THEN '<image>' ELSE '' END || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text
FROM (SELECT *, role = 'user' AND contains(text, chr(10)) AS seen FROM conversations) GROUP BY conv_id
""")
def multimodal_flags(t: Tables):
    return _with_parts(t).select("conv_id", is_multimodal(F.col("conversations")).alias("multimodal"), render(F.col("conversations")).alias("text"))


@query("""
SELECT CASE WHEN bool_or(role = 'user' AND contains(text, chr(10))) THEN 'multimodal' ELSE 'text' END AS route FROM conversations
""")
def modality_route(t: Tables):
    return multimodal_route(_with_parts(t))


def jsonl_file(t: Tables) -> str:
    """Conversation records as JSON lines in the shared folder, in conversation order."""
    path = new_path(t.spark, "jsonl")
    lines = nest_turns(t.conversations).select("conv_id", conversation_line(F.col("conversations")).alias("line"))
    write_lines(lines.repartitionByRange("conv_id").sortWithinPartitions("conv_id"), path)
    return path


@query(f"SELECT count(*) AS turns, {CHAT_SQL} AS text FROM conversations GROUP BY conv_id")
def jsonl_round_trip(t: Tables):
    records = read_conversations(t.spark, jsonl_file(t))
    return records.select(F.size("conversations").cast("bigint").alias("turns"), render(F.col("conversations")).alias("text"))


@query("""
SELECT 'sample_' || (row_number() OVER (ORDER BY conv_id) - 1) AS sample, question, '{}' AS ground_truth FROM (
  SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS question
  FROM conversations GROUP BY conv_id)
""")
def jsonl_tasks(t: Tables):
    """Tasks from prepared records; the replies here are prose, so no truth is readable JSON."""
    return conversation_tasks(read_conversations(t.spark, jsonl_file(t)))


@query(f"""
SELECT CASE WHEN conv_id % 5 = 0 THEN 'bad' ELSE 'good' END AS side,
       CASE WHEN conv_id % 5 = 0 THEN left(line, length(line) - 2) ELSE line END AS line,
       CASE WHEN conv_id % 5 = 0 THEN row_number() OVER (ORDER BY conv_id) END AS line_no
FROM (SELECT conv_id, {LINE_SQL} AS line FROM conversations GROUP BY conv_id)
""")
def tolerant_lines(t: Tables):
    """Lines of which every fifth is cut off, read with the tolerant reader from one file per run of lines."""
    path = new_path(t.spark, "cut")
    cut = F.when(F.col("conv_id") % 5 == 0, F.substring("line", F.lit(1), F.length("line") - 2)).otherwise(F.col("line"))
    lines = nest_turns(t.conversations).select("conv_id", conversation_line(F.col("conversations")).alias("line")).withColumn("line", cut)
    write_lines(lines.repartitionByRange("conv_id").sortWithinPartitions("conv_id"), path)
    good, bad = read_tolerant(t.spark, path)
    # line_no counts within a part file; the rows of the files before are added to compare with one count.
    sizes = read_lines(t.spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    bad = bad.join(before, "file").select(F.lit("bad").alias("side"), "line", (F.col("line_no") + F.col("before")).alias("line_no"))
    return good.select(F.lit("good").alias("side"), "line", F.lit(None).cast("bigint").alias("line_no")).unionByName(bad)
