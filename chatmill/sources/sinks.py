"""Writers. Every sink is a directory of part files whose names follow the row order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chatmill.functions.targets import quote
from chatmill.operators.combine import record_counts
from chatmill.operators.split import EVAL, TRAIN
from chatmill.sources.files import file_system, move, remove


def turn_json(t: Column) -> Column:
    """A turn as JSON text; content is the text, or the list of parts."""

    def part(p: Column) -> Column:
        keys = [F.when(p[k].isNotNull(), F.concat(F.lit(f'"{k}": '), quote(p[k]))) for k in ("type", "image", "text")]
        return F.coalesce(p["json"], F.concat(F.lit("{"), F.concat_ws(", ", *keys), F.lit("}")))

    parts = F.concat(F.lit("["), F.array_join(F.transform(t["parts"], part), ", "), F.lit("]"))
    content = F.coalesce(quote(t["content"]), parts, F.lit("null"))
    role = F.when(t["role"].isNotNull(), F.concat(F.lit('"role": '), quote(t["role"]), F.lit(", ")))
    return F.concat(F.lit("{"), F.coalesce(role, F.lit("")), F.lit('"content": '), content, F.lit("}"))


def conversation_line(conversations: Column) -> Column:
    """A conversation record as one JSON line, non-ASCII kept."""
    return F.concat(F.lit('{"conversations": ['), F.array_join(F.transform(conversations, turn_json), ", "), F.lit("]}"))


def publish_lines(outputs: dict[str, DataFrame], may_be_empty: bool = False) -> dict[str, int]:
    """Write several tables of one text column, each to its path, all of them or none; returns their numbers of lines.

    Everything is first written to hidden folders beside the paths, and counted as it is written, the last table first: of a split that is the smaller
    one, and if it is empty the others need not be made. Only if no table is empty the folders take the
    place of what was there, by renaming; if a renaming fails, those before it are undone. A job that dies leaves hidden folders, never half an output.
    """
    spark = next(iter(outputs.values())).sparkSession
    run, hidden, counts = uuid.uuid4().hex, {}, {}

    def beside(path: str, mark: str) -> str:
        folder, slash, name = path.rstrip("/").rpartition("/")
        return f"{folder}{slash}.{name}.{mark}-{run}"

    try:
        for path, df in reversed(outputs.items()):
            hidden[path], seen = beside(path, "new"), Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.text(hidden[path])
            counts[path] = seen.get["n"]
            if not counts[path] and not may_be_empty:
                raise ValueError(f"no samples for {path}; nothing is written")
        moved: list[tuple[str, bool]] = []
        try:
            for path in outputs:
                before = move(spark, path, beside(path, "old"))
                moved.append((path, before))
                if not move(spark, hidden[path], path):
                    raise OSError(f"cannot rename to {path}")
        except Exception:
            for path, before in reversed(moved):
                remove(spark, path)
                if before:
                    move(spark, beside(path, "old"), path)
            raise
        for path, before in moved:
            if before:
                remove(spark, beside(path, "old"))
    finally:
        for path in hidden.values():
            remove(spark, path)
    return counts


def write_conversations(df: DataFrame, path: str, may_be_empty: bool = True) -> int:
    """Overwrite `path` with one JSON line per record; returns their number. What was there stays until all is written."""
    return publish_lines({path: df.select(conversation_line(F.col("conversations")).alias("value"))}, may_be_empty)[path]


def write_lines(df: DataFrame, path: str, line: str = "line", may_be_empty: bool = True) -> int:
    """Overwrite `path` with ready-made lines, such as those of merged datasets; returns their number."""
    return publish_lines({path: df.select(F.col(line).alias("value"))}, may_be_empty)[path]


def eval_path(path: str) -> str:
    """`<stem>_eval<suffix>` next to the train path."""
    folder, slash, name = path.rpartition("/")
    stem, dot, suffix = name.rpartition(".")
    return f"{folder}{slash}{stem}_eval{dot}{suffix}" if stem else f"{path}_eval"


def write_split(train: DataFrame, evaluation: DataFrame, path: str) -> str:
    """Write both sides of a split, none of which may be empty: then the last outputs stay as they are. Returns the eval path."""
    sides = {path: train, eval_path(path): evaluation}
    publish_lines({p: df.select(conversation_line(F.col("conversations")).alias("value")) for p, df in sides.items()})
    return eval_path(path)


def dry_run(df: DataFrame, by: str = "source") -> DataFrame:
    """The counts a write would report; nothing is written."""
    return record_counts(df, by)


def write_dataset(train: DataFrame, evaluation: DataFrame | None, path: str, dry: bool = False) -> DataFrame:
    """Write a prepared dataset, or only count it: one row (`side`, `path`, `records`) for each side. An empty side is an error, with nothing written.

    A dry run reads and builds the same records; it counts them instead of writing.
    """
    sides = {TRAIN: (train, path)} | ({EVAL: (evaluation, eval_path(path))} if evaluation is not None else {})
    lines = {p: df.select(conversation_line(F.col("conversations")).alias("value")) for df, p in sides.values()}
    counts = {p: df.count() for p, df in lines.items()} if dry else publish_lines(lines)
    if empty := [side for side, (_, p) in sides.items() if not counts[p]]:
        raise ValueError(f"no samples for {', '.join(empty)}; nothing is written")
    return train.sparkSession.createDataFrame([(side, p, counts[p]) for side, (_, p) in sides.items()], "side string, path string, records long")


def append_results(results: DataFrame, path: str) -> None:
    """Append result rows to a log, nulls included."""
    results.write.mode("append").option("ignoreNullFields", False).json(path)


def append_summary(summary: DataFrame, path: str) -> DataFrame:
    """Append a summary as a row of the log that readers of results pass over; returns the summary as written."""
    row = summary.sparkSession.createDataFrame(summary.collect(), summary.schema)
    row.coalesce(1).withColumn("_summary", F.lit(True)).write.mode("append").option("ignoreNullFields", False).json(path)
    return row


def unfinished(tasks: DataFrame, done: DataFrame, key: str | list[str] = "sample") -> DataFrame:
    """Tasks without a row in the result log, for a restart."""
    keys = [key] if isinstance(key, str) else key
    return tasks.join(done.select(*keys).distinct(), keys, "left_anti")


def write_files(df: DataFrame, folder: str, path: str = "path", text: str = "text") -> None:
    """Write each row as a text file of its own, at `path` below the folder; a file of that name is replaced.

    Files are written by the tasks that hold the rows, to any file system that pyarrow knows; a task that is tried again writes the same
    files again. Null texts are empty files, a null path is an error.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        system, base = file_system(folder)
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                target = f"{base.rstrip('/')}/{name}"
                parent = target.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(target) as out:
                    out.write((content or "").encode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int32())], ["n"])

    named = F.when(F.col(path).isNotNull(), F.col(path)).otherwise(F.raise_error(F.lit("a file without a path")).cast("string"))
    df.select(named, F.col(text)).mapInArrow(write, "n int").write.format("noop").mode("overwrite").save()
