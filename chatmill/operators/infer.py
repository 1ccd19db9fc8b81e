"""Asking a model for every row of a task table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.functions.fields import score_fields
from chatmill.functions.metrics import score_columns
from chatmill.schemas import METRICS, PROFILE_FIELDS, FieldSpec
from chatmill.sources.journal import SegmentWriter

REPLY = (
    T.StructField("raw_response", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
)
_ARROW = {"raw_response": pa.string(), "latency_s": pa.float64(), "status": pa.string(), "timestamp": pa.timestamp("us", "UTC")}


@dataclass(frozen=True)
class Request:
    """One chat request as handed to the client, which builds the payload for its service."""

    system: str
    user: str
    temperature: float
    max_tokens: int
    seed: int
    thinking: bool
    timeout_s: float


@dataclass(frozen=True)
class InferSettings:
    temperature: float = 0.0
    max_tokens: int = 1024
    seed: int = 42
    thinking: bool = False
    timeout_s: float = 120.0
    retries: int = 3
    threads: int = 4


Client = Callable[[Request], str | None]

# Requests for each thread that are under way or wait for their next attempt; rows handed on together.
AHEAD, HANDED_ON = 16, 64

Row = tuple[pa.RecordBatch, int]


def doubling(made: int) -> float:
    """Seconds to wait after so many failed attempts: 1, 2, 4, ..."""
    return float(1 << (made - 1))


def answers(
    client: Client, requests: Iterator[tuple[Row, Request]], settings: InferSettings, pause: Callable[[int], float] = doubling, clock: Callable[[], float] = time.monotonic
) -> Iterator[tuple[Row, dict]]:
    """Each request's mark with its reply, as replies become final: the one that worked with the latency of its attempt, or an error after the last.

    A request that failed waits in a heap of due times and holds no thread while it does; threads take what is due first, then new requests. At most
    AHEAD requests a thread are under way or waiting, so a service that fails for all of them is not asked for more.
    """
    due: list[tuple[float, int, Row, Request, int, datetime]] = []
    running: dict[Future, tuple[Row, Request, int, datetime]] = {}
    number, more = 0, True

    def attempt(request: Request) -> dict | Exception:
        asked_at = clock()
        try:
            reply = client(request)
        except Exception as failure:  # whatever the client raises
            return failure
        return {"raw_response": reply or "", "latency_s": round(clock() - asked_at, 3), "status": "ok"}

    with ThreadPoolExecutor(settings.threads) as pool:
        while True:
            while len(running) < settings.threads:
                if due and due[0][0] <= clock():
                    _, _, mark, request, made, began = heappop(due)
                elif more and len(due) + len(running) < settings.threads * AHEAD:
                    taken = next(requests, None)
                    if taken is None:
                        more = False
                        continue
                    (mark, request), made, began = taken, 0, datetime.now(timezone.utc)
                else:
                    break
                running[pool.submit(attempt, request)] = mark, request, made + 1, began
            if not running:
                if not due:
                    return
                time.sleep(max(0.0, due[0][0] - clock()))
                continue
            free = len(running) < settings.threads
            for done in wait(running, max(0.0, due[0][0] - clock()) if due and free else None, FIRST_COMPLETED).done:
                mark, request, made, began = running.pop(done)
                reply = done.result()
                if not isinstance(reply, Exception):
                    yield mark, reply | {"timestamp": began}
                elif made < settings.retries:
                    number += 1
                    heappush(due, (clock() + pause(made), number, mark, request, made, began))
                else:
                    # Fixed value: the wording of a failed request's status.
                    yield mark, {"raw_response": "", "latency_s": None, "status": f"error: Request failed after {settings.retries} attempts: {reply}", "timestamp": began}


def ask_model(
    tasks: DataFrame,
    client_factory: Callable[[], Client],
    settings: InferSettings = InferSettings(),
    system: str = "system",
    user: str = "question",
    pause: Callable[[int], float] = doubling,
    clock: Callable[[], float] = time.monotonic,
    journal: str | None = None,
    key: str = "task",
    flush_s: float = 5.0,
) -> DataFrame:
    """Add `raw_response`, `latency_s`, `status` and `timestamp` to every task row.

    The factory must be picklable; it is called once per task on the executor. Requests in flight are the
    running Spark tasks times `settings.threads`, so bound the load on a service by repartitioning the tasks.
    Rows come back as their replies do, not in their order, and no task holds more than a few for each thread.

    With `journal`, a folder as Journal.new_run gives it, every reply is also written there within `flush_s` seconds, under the row's `key`: what a
    killed task, stage or driver has been told is not asked again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        here = TaskContext.get()
        segment = SegmentWriter(journal, f"{here.partitionId()}-{here.taskAttemptId()}", flush_s) if journal else None

        def requests() -> Iterator[tuple[Row, Request]]:
            for batch in batches:
                for at, texts in enumerate(zip(*(batch.column(name).to_pylist() for name in (system, user)), strict=True)):
                    yield (batch, at), Request(*texts, settings.temperature, settings.max_tokens, settings.seed, settings.thinking, settings.timeout_s)

        def handed_on(rows: list[tuple[Row, dict]]) -> Iterator[pa.RecordBatch]:
            for _, group in groupby(rows, key=lambda r: id(r[0][0])):
                held = list(group)
                batch = held[0][0][0].take(pa.array([at for (_, at), _ in held]))
                columns = [pa.array([reply[name] for _, reply in held], kind) for name, kind in _ARROW.items()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *_ARROW])

        try:
            ready: list[tuple[Row, dict]] = []
            for (batch, at), reply in answers(client, requests(), settings, pause, clock):
                if segment:
                    segment.add({"task": batch.column(key)[at].as_py(), **reply})
                ready.append(((batch, at), reply))
                if len(ready) >= HANDED_ON:
                    yield from handed_on(ready)
                    ready = []
            yield from handed_on(ready)
        finally:
            if segment:
                segment.close()

    return tasks.mapInArrow(run, T.StructType([*tasks.schema.fields, *REPLY]))


def _blank_unless_answered(df: DataFrame, names: list[str]) -> DataFrame:
    answered = ~F.col("request_status").startswith("error")
    return df.withColumns({n: F.when(answered, F.col(n)) for n in names})


def evaluate_documents(replies: DataFrame) -> DataFrame:
    """Document result rows: metrics of answered requests, nulls and an empty reply for failed ones."""
    scored = score_columns(replies.withColumn("request_status", F.col("status")))
    return _blank_unless_answered(scored, list(METRICS)).drop("request_status")


def evaluate_profiles(replies: DataFrame, fields: tuple[FieldSpec, ...] = PROFILE_FIELDS) -> DataFrame:
    """Extraction result rows: field flags of answered requests, nulls for failed ones."""
    scored = score_fields(replies.withColumnRenamed("status", "request_status"), fields=fields)
    answered = ~F.col("request_status").startswith("error")
    scored = scored.withColumn("status", F.when(answered, F.col("status")).otherwise(F.col("request_status")))
    names = [f"field_{f.name}" for f in fields] + ["fields_matched", "field_accuracy"]
    return _blank_unless_answered(scored, names).drop("request_status", "predicted", "strategy")


def join_replies(tasks: DataFrame, replies: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(tasks with their reply, tasks without one)."""
    return tasks.join(replies, key), tasks.join(replies, key, "left_anti")
