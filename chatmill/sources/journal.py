"""A journal of replies: rows leave the asking task every few seconds, so that a crash loses few of them."""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.sources.files import file_system, names_in, put_new, remove, text_of

ENTRY = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("raw_response", T.StringType()),
        T.StructField("latency_s", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


class SegmentWriter:
    """One task's share of the journal: what has come in is written as a file of its own every `flush_s` seconds, or when `flush_rows` have come.

    Used inside a task, from several threads. `folder` is a path of any file system that pyarrow knows; a file is named by the task, its attempt
    and its place, and gets this name when it is whole.
    """

    def __init__(self, folder: str, name: str, flush_s: float = 5.0, flush_rows: int = 500):
        self.fs, self.folder = file_system(folder)
        self.name, self.flush_rows = name, flush_rows
        self.rows: list[str] = []
        self.written, self.lock, self.closed = 0, threading.Lock(), threading.Event()
        self.fs.create_dir(self.folder, recursive=True)
        self.timer = threading.Thread(target=self._every, args=(flush_s,), daemon=True)
        self.timer.start()

    def _every(self, seconds: float) -> None:
        while not self.closed.wait(seconds):
            self.flush()

    def add(self, row: dict) -> None:
        line = json.dumps(row, ensure_ascii=False, default=datetime.isoformat)
        with self.lock:
            self.rows.append(line)
            full = len(self.rows) >= self.flush_rows
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            if not self.rows:
                return
            hidden, whole = (f"{self.folder}/{mark}{self.name}-{self.written}.jsonl" for mark in (".", ""))
            with self.fs.open_output_stream(hidden) as out:
                out.write(("\n".join(self.rows) + "\n").encode("utf-8", "replace"))
            self.fs.move(hidden, whole)
            self.written, self.rows = self.written + 1, []

    def close(self) -> None:
        self.closed.set()
        self.timer.join()
        self.flush()


class Journal:
    """Replies by task, in a folder: segments of each run (`run-<id>`), a base that earlier runs are folded into, and the list of commits that says
    which runs the base holds (`commits/<n>`, the highest number counts).

    Every reply counts from the moment its segment is written, whether its task, its job or the driver lives on. A task that is tried again, and a
    reply that is in a segment and in the base, give the same key twice: of several replies of a task an answered one counts, and the latest of these.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def new_run(self) -> str:
        """The folder of segments of a run that begins."""
        return f"{self.folder}/run-{uuid.uuid4().hex}"

    def _commit(self) -> tuple[int, dict]:
        numbers = [int(n) for n in names_in(self.spark, f"{self.folder}/commits") if n.isdigit()]
        if not numbers:
            return 0, {"base": None, "runs": []}
        return max(numbers), json.loads(text_of(self.spark, f"{self.folder}/commits/{max(numbers)}"))

    def _runs(self) -> list[str]:
        return [n for n in names_in(self.spark, self.folder) if n.startswith("run-")]

    def _rows(self, base: str | None, runs: list[str]) -> DataFrame:
        from chatmill.sources.logs import read_log_lines

        rows = self.spark.createDataFrame([], ENTRY)
        if runs:
            lines = self.spark.read.option("pathGlobFilter", "*.jsonl").text([f"{self.folder}/{r}" for r in runs])
            rows = rows.unionByName(read_log_lines(lines, ENTRY).drop("__path"))
        if base:
            rows = rows.unionByName(self.spark.read.schema(ENTRY).parquet(f"{self.folder}/{base}"))
        best = F.max_by(F.struct(*ENTRY.fieldNames()), F.struct(F.col("status") == "ok", "timestamp", "raw_response"))
        return rows.filter(F.col("task").isNotNull()).groupBy("task").agg(best.alias("r")).select("r.*")

    def replies(self) -> DataFrame:
        """One row per task."""
        _, commit = self._commit()
        return self._rows(commit["base"], [r for r in self._runs() if r not in commit["runs"]])

    def compact(self) -> int:
        """Fold the segments of all runs, which must have ended, into a new base; returns the number of the commit.

        The base is written first and counts with its commit, so a compaction that dies changes nothing, and one that is repeated gives the
        same rows. What an earlier commit had folded already, and its base, go; what this one folds stays until the next, for readers that have begun.
        """
        number, commit = self._commit()
        runs, base = self._runs(), f"base-{uuid.uuid4().hex}"
        self._rows(commit["base"], [r for r in runs if r not in commit["runs"]]).write.parquet(f"{self.folder}/{base}")
        if not put_new(self.spark, f"{self.folder}/commits/{number + 1}", json.dumps({"base": base, "runs": runs})):
            raise RuntimeError(f"another driver compacts {self.folder}")
        for old in commit["runs"]:
            remove(self.spark, f"{self.folder}/{old}")
        for name in names_in(self.spark, self.folder):
            if name.startswith("base-") and name not in (base, commit["base"]):
                remove(self.spark, f"{self.folder}/{name}")
        return number + 1
