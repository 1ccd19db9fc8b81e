"""Journal of replies, published versions, outputs written whole or not at all, and waiting retries."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from chatmill.operators.infer import InferSettings, Request, answers, ask_model
from chatmill.plans.evaluation import evaluate_document_tasks
from chatmill.sources.files import names_in, put_new
from chatmill.sources.journal import Journal, SegmentWriter
from chatmill.sources.sinks import publish_lines, write_dataset
from chatmill.sources.snapshots import current_version, note_of, point, publish, read_current


@pytest.fixture(scope="module", autouse=True)
def clients_on_executors(spark):
    spark.sparkContext.addPyFile(__file__)


class Dies:
    """Answers slowly, notes each question, and ends the task at `q39` until a marker file exists."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        return self.ask

    def ask(self, request):
        import os

        with open(f"{self.folder}/asked", "a") as f:
            f.write(request.user + "\n")
        time.sleep(0.05)
        if request.user == "q39" and not os.path.exists(f"{self.folder}/mended"):
            time.sleep(0.5)
            os.kill(os.getpid(), 9)
        return request.user


def test_a_killed_worker_loses_one_flush(spark, tmp_path):
    tasks = spark.createDataFrame([(f"q{i}", "s") for i in range(80)], "question string, system string").withColumn("task", F.col("question")).coalesce(1)
    journal = Journal(spark, str(tmp_path / "journal"))
    with pytest.raises(Exception):
        ask_model(tasks, Dies(str(tmp_path)), InferSettings(threads=2), journal=journal.new_run(), flush_s=0.2).write.format("noop").mode("overwrite").save()
    kept = {r.task for r in journal.replies().collect()}
    asked = (tmp_path / "asked").read_text().split()
    # Asked in the last flush interval, or under way: 0.2 s at 2 threads and 0.05 s a request.
    assert len(kept) >= 35 and 1 <= len(set(asked) - kept) <= 12
    (tmp_path / "mended").touch()
    (tmp_path / "asked").write_text("")
    rest = tasks.join(journal.replies().select("task"), "task", "left_anti")
    ask_model(rest, Dies(str(tmp_path)), InferSettings(threads=2), journal=journal.new_run()).write.format("noop").mode("overwrite").save()
    assert set((tmp_path / "asked").read_text().split()) == {f"q{i}" for i in range(80)} - kept
    assert {r.task for r in journal.replies().collect()} == {f"q{i}" for i in range(80)}


def test_compaction_keeps_every_reply(spark, tmp_path):
    journal = Journal(spark, str(tmp_path / "j"))
    assert journal.replies().count() == 0
    rows = [("a", "error: x", "", 1), ("a", "ok", "first", 2), ("b", "error: x", "", 1), ("c", "ok", "old", 1), ("c", "ok", "new", 2), ("a", "error: y", "", 9)]
    for n, (task, status, reply, second) in enumerate(rows):
        writer = SegmentWriter(journal.new_run(), f"0-{n}", flush_s=60)
        writer.add({"task": task, "raw_response": reply, "latency_s": 0.5, "status": status, "timestamp": f"2026-01-01T00:00:0{second}+00:00"})
        writer.close()
        if n in (1, 3):
            assert journal.compact() == (n + 1) // 2
    run = journal.new_run()
    put_new(spark, f"{run}/cut-0.jsonl", '{"task": "d", "status": "ok", "raw')
    put_new(spark, f"{run}/.1-1-0.jsonl", '{"task": "hidden", "status": "ok"}')
    want = {("a", "ok", "first"), ("b", "error: x", ""), ("c", "ok", "new")}
    for _ in range(3):
        assert {(r.task, r.status, r.raw_response) for r in journal.replies().collect()} == want
        journal.compact()
    names = names_in(spark, str(tmp_path / "j"))
    assert sum(n.startswith("base-") for n in names) == 2 and not any(n.startswith("run-") for n in names)
    # A compaction that dies before its commit changes nothing.
    spark.range(5).write.parquet(str(tmp_path / "j" / "base-dead"))
    assert {(r.task, r.status, r.raw_response) for r in journal.replies().collect()} == want


def test_retries_hold_no_thread():
    lock, seen, now, most = threading.Lock(), {}, [0], [0]

    def client(request):
        with lock:
            seen[request.user] = seen.get(request.user, 0) + 1
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        if int(request.user) % 2 and seen[request.user] == 1:
            raise TimeoutError("once")
        return request.user

    requests = ((i, Request("", str(i), 0.0, 1, 1, False, 1.0)) for i in range(100))
    start = time.monotonic()
    got = dict(answers(client, requests, InferSettings(threads=4, retries=2), pause=lambda _: 0.6))
    took = time.monotonic() - start
    assert sorted(got) == list(range(100)) and all(r["status"] == "ok" for r in got.values()) and most[0] == 4
    # 150 requests of 0.02 s on 4 threads, and the last pause; waiting in the threads would take 50 * 0.6 / 4 s more.
    assert took < 3


def test_requests_wait_in_bounds():
    asked = []

    def client(request):
        asked.append(request.user)
        raise ConnectionError("down")

    pulled = []

    def requests():
        for i in range(1000):
            pulled.append(i)
            yield i, Request("", str(i), 0.0, 1, 1, False, 1.0)

    replies = answers(client, requests(), InferSettings(threads=2, retries=2), pause=lambda _: 0.05)
    first = next(replies)
    assert len(pulled) <= 2 * 16 + 1 and first[1]["status"] == "error: Request failed after 2 attempts: down"
    assert sum(1 for _ in replies) == 999 and len(asked) == 2000


class Moody:
    """Fails for odd questions until a marker file exists."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        return self.ask

    def ask(self, request):
        import os

        if request.user in ("q1", "q3") and not os.path.exists(f"{self.folder}/up"):
            raise ConnectionError("busy")
        return request.user


def test_failed_requests_are_asked_again_if_wanted(spark, tmp_path):
    rows = [("d", "", f"q{i}", f"q{i}") for i in range(4)] + [("d", "", "q0", "q0"), (None, "", "q2", None)]
    tasks = spark.createDataFrame(rows, "doc string, system string, question string, ground_truth string")
    log, client, once = str(tmp_path / "log"), Moody(str(tmp_path)), InferSettings(retries=1)

    def run(**more):
        r = evaluate_document_tasks(tasks, client, log, once, **more).first()
        return r.n_total, r.n_ok, r.n_error

    assert run() == (6, 4, 2)
    (tmp_path / "up").touch()
    assert run() == (6, 4, 2)  # a failed request is done
    assert spark.read.json(log).filter("_summary").count() == 1
    assert run(retry_failed=True) == (6, 6, 0)
    assert run(retry_failed=True) == (6, 6, 0)
    assert spark.read.json(log).filter("_summary").count() == 2 and spark.read.json(log).filter("_summary is null").count() == 8


def test_readers_find_whole_versions(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert current_version(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, folder)
    rows = spark.range(0, 40, 1, 2)
    publish(rows.withColumn("v", F.lit(1)), folder)
    seen, stop, faults = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                got = read_current(spark, folder).groupBy("v").count().collect()
                if len(got) != 1 or got[0]["count"] != 40:
                    faults.append(got)
                seen.add(got[0]["v"])
            except Exception as e:
                faults.append(e)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    for n in range(2, 41):
        assert publish(rows.withColumn("v", F.lit(n)), folder, keep=10) == n
    stop.set()
    for r in readers:
        r.join()
    assert not faults and len(seen) > 3
    assert [n for n in names_in(spark, folder) if n.startswith("v=")] == sorted(f"v={n}" for n in range(31, 41))
    rows.write.parquet(f"{folder}/v=41")  # a writer that died before its pointer
    assert current_version(spark, folder) == 40 and publish(rows, folder, keep=2) == 42
    assert names_in(spark, f"{folder}/_current") == ["40", "42"]
    with pytest.raises(ValueError):
        publish(rows, folder, keep=1)
    assert point(spark, str(tmp_path / "n"), "one") == 1 and point(spark, str(tmp_path / "n"), "two") == 2
    assert note_of(spark, str(tmp_path / "n")) == "two"


def test_outputs_are_replaced_together(spark, tmp_path):
    a, b = str(tmp_path / "out" / "a.jsonl"), str(tmp_path / "out" / "b.jsonl")
    lines = spark.createDataFrame([("x",), ("y",)], "value string")
    assert publish_lines({a: lines, b: lines.limit(1)}) == {a: 2, b: 1}
    with pytest.raises(ValueError, match="nothing is written"):
        publish_lines({a: lines.limit(1), b: lines.limit(0)})
    bad = lines.select(F.when(F.col("value") == "y", F.raise_error(F.lit("torn")).cast("string")).otherwise(F.col("value")).alias("value"))
    with pytest.raises(Exception):
        publish_lines({a: lines.limit(1), b: bad})
    assert spark.read.text(a).count() == 2 and spark.read.text(b).count() == 1
    assert names_in(spark, str(tmp_path / "out")) == ["a.jsonl", "b.jsonl"]
    assert publish_lines({a: lines.limit(1), b: lines}) == {a: 1, b: 2}
    records = spark.createDataFrame([([("user", "hi", None)],)], "conversations array<struct<role: string, content: string, parts: array<struct<type: string, image: string, text: string, json: string>>>>")
    path = str(tmp_path / "out" / "train.jsonl")
    assert [tuple(r) for r in write_dataset(records, records, path, dry=True).collect()] == [("train", path, 1), ("eval", path.replace("train", "train_eval"), 1)]
    assert names_in(spark, str(tmp_path / "out")) == ["a.jsonl", "b.jsonl"]
    for dry in (True, False):
        with pytest.raises(ValueError):
            write_dataset(records, records.limit(0), path, dry)
    assert write_dataset(records, None, path).count() == 1
    assert json.loads(spark.read.text(path).first()[0]) == {"conversations": [{"role": "user", "content": "hi"}]}
