import json
import os

import pytest
from pyspark.sql import functions as F

from chatmill.operators.infer import InferSettings, ask_model, evaluate_documents
from chatmill.operators.report import accuracy_bar, first_error, latency_histogram, score_histogram
from chatmill.plans.evaluation import evaluate_document_tasks, evaluate_profile_tasks
from chatmill.schemas import LOG_ENTRY
from chatmill.sources.journal import Journal
from chatmill.sources.snapshots import read_current
from chatmill.streaming.monitor import TrainingMonitor, panel_table
from chatmill.streaming.results import append_scored, read_stream, rolling_summary


@pytest.fixture(scope="module", autouse=True)
def clients_on_executors(spark):
    spark.sparkContext.addPyFile(__file__)


class Flaky:
    """Fails `n` times for a question `fail n`, echoes all others; `none` has no reply."""

    def __init__(self):
        self.seen = {}

    def __call__(self, request):
        kind, _, n = request.user.partition(" ")
        self.seen[request.user] = self.seen.get(request.user, 0) + 1
        if kind == "fail" and self.seen[request.user] <= int(n):
            raise TimeoutError(f"attempt {self.seen[request.user]}")
        return None if kind == "none" else f"{request.system}:{request.user}"


def test_asking(spark):
    tasks = spark.createDataFrame([(i, "s", q) for i, q in enumerate(["a", "fail 1", "fail 2", "fail 3", "none"])], "i int, system string, question string")
    waits = InferSettings(retries=3, threads=2)
    got = ask_model(tasks.coalesce(1), Flaky, waits, pause=lambda made: (1 << made) / 1000).orderBy("i").collect()
    assert [r.status for r in got] == ["ok", "ok", "ok", "error: Request failed after 3 attempts: attempt 3", "ok"]
    assert [r.raw_response for r in got] == ["s:a", "s:fail 1", "s:fail 2", "", ""]
    assert got[3].latency_s is None and all(r.latency_s is not None for r in got if r.status == "ok")


def test_document_evaluation(spark, tmp_path):
    tasks = spark.createDataFrame([("d", "", "a", ":a"), ("d", "", "fail 9", "x")], "doc string, system string, question string, ground_truth string")
    rows = evaluate_documents(ask_model(tasks, Flaky, InferSettings(retries=1))).orderBy("question").collect()
    assert (rows[0].exact_match, rows[0].rougeL_f, rows[1].exact_match, rows[1].edit_sim, rows[1].response) == (1.0, 1.0, None, None, "")
    summary = evaluate_document_tasks(tasks, Flaky, str(tmp_path / "log"), InferSettings(retries=1)).first()
    assert (summary.n_total, summary.n_ok, summary.n_error, summary.edit_sim_mean) == (2, 1, 1, 1.0)


class Counting:
    """Answers what is asked, notes it in a file, and fails on one question until a marker file exists."""

    folder = ""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        return self.ask

    def ask(self, request):
        with open(f"{self.folder}/asked", "a") as f:
            f.write(request.user + "\n")
        if request.user == "q3" and not os.path.exists(f"{self.folder}/mended"):
            raise SystemExit("the job is killed")
        return request.user


def test_restart_asks_only_for_what_is_missing(spark, tmp_path):
    tasks = spark.createDataFrame([("d", "", f"q{i}", f"q{i}") for i in range(12)], "doc string, system string, question string, ground_truth string")
    client, log = Counting(str(tmp_path)), str(tmp_path / "log")
    with pytest.raises(Exception):
        evaluate_document_tasks(tasks, client, log, InferSettings(retries=1), flush_s=0.1)
    before = Journal(spark, f"{log}_journal").replies().count()
    (tmp_path / "mended").touch()
    os.makedirs(log, exist_ok=True)
    with open(f"{log}/part-cut.json", "w") as f:
        f.write('{"doc": "d", "question": "q')
    (tmp_path / "asked").write_text("")
    summary = evaluate_document_tasks(tasks, client, log, InferSettings(retries=1), flush_s=0.1).first()
    assert summary.n_total == summary.n_ok == 12
    assert 0 < before < 12 and len((tmp_path / "asked").read_text().split()) == 12 - before
    again = evaluate_document_tasks(tasks, client, log, InferSettings(retries=1), flush_s=0.1).first()
    assert again.n_total == 12 and len((tmp_path / "asked").read_text().split()) == 12 - before
    assert spark.read.json(log).filter("_summary").count() == 1  # nothing new, no other summary


class Canned:
    def __call__(self, request):
        if request.user == "down":
            raise ConnectionError("no route")
        return request.user


def test_profile_evaluation(spark, tmp_path):
    rows = [("s0", '{"name": "Ann"}', '{"name": "ann"}'), ("s1", "no json", "{}"), ("s2", "down", "{}")]
    tasks = spark.createDataFrame(rows, "sample string, question string, ground_truth string")
    summary = evaluate_profile_tasks(tasks, Canned, str(tmp_path / "log"), InferSettings(retries=1)).first()
    assert (summary.n_total, summary.n_ok, summary.n_error, summary.field_accuracy_mean, summary.field_name_accuracy) == (3, 1, 2, 1.0, 1.0)
    log = {r["sample"]: r for r in spark.read.json(str(tmp_path / "log")).collect()}
    assert log["s1"].status == "parse_error" and log["s1"].field_name is True
    assert log["s2"].field_name is None and log["s2"].fields_total == 10 and log["s2"].status.startswith("error: ")


def test_histograms(spark):
    rows = [(0.0, 1.0, "ok"), (0.04, 1.0, "ok"), (1.0, 1.0, "ok"), (0.5, 1.0, "error: x"), (0.999, None, "ok")]
    df = spark.createDataFrame(rows, "rougeL_f double, latency_s double, status string")
    bins = {r.bin: r.n for r in score_histogram(df).collect()}
    assert len(bins) == 25 and bins[1] == 1 and bins[2] == 1 and bins[25] == 2 and sum(bins.values()) == 4
    flat = {r.bin: r.n for r in latency_histogram(df).collect()}
    assert len(flat) == 30 and flat[16] == 3 and sum(flat.values()) == 3


def test_first_error_and_bar(spark, column):
    rows = [("a", "ok", "r", 1), ("b", "error: two", "", 3), ("c", "error: one", "", 2), ("d", "parse_error", "x" * 200, 4)]
    df = spark.createDataFrame(rows, "sample string, status string, raw_response string, timestamp int")
    assert tuple(first_error(df).first()) == ("error: one", "x" * 120)
    assert tuple(first_error(df.filter("status = 'ok'")).first()) == (None, None)
    assert column(accuracy_bar, [0.0, 0.125, 0.5, 1.0], "double") == ["", "██", "█" * 10, "█" * 20]


def test_streamed_results(spark, tmp_path):
    source, out, summary = (str(tmp_path / n) for n in ("in", "out", "summary"))
    (tmp_path / "in").mkdir()
    schema = spark.createDataFrame([], "doc string, status string, score double").schema

    def feed(name, rows):
        (tmp_path / "in" / name).write_text("".join(json.dumps(dict(zip(["doc", "status", "score"], r, strict=True))) + "\n" for r in rows))
        stream = read_stream(spark, source, schema, files_per_batch=1)
        append_scored(stream, lambda df: df.withColumn("double", F.col("score") * 2), out, f"{out}-cp").awaitTermination()
        rolling_summary(read_stream(spark, source, schema), ["doc"], ("score",), summary, f"{summary}-cp").awaitTermination()

    feed("1.json", [("a", "ok", 1.0), ("b", "ok", 0.5), ("a", "error: x", 9.0)])
    feed("2.json", [("a", "ok", 0.0)])
    assert sorted(r.double for r in spark.read.parquet(out).collect()) == [0.0, 1.0, 2.0, 18.0]
    assert {r.doc: (r.n_total, r.n_ok, r.score_mean) for r in read_current(spark, summary).collect()} == {"a": (3, 2, 0.5), "b": (1, 1, 0.5)}


def test_asking_in_a_stream(spark, tmp_path):
    """Finished micro-batches stay when a run breaks off; a restart asks only for what came since."""
    (tmp_path / "in").mkdir()
    schema = spark.createDataFrame([], "doc string, system string, question string, ground_truth string").schema
    for name in ("a", "none", "fail 9"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps({"doc": name, "system": "s", "question": name, "ground_truth": "s:a"}) + "\n")
        rows = read_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
        append_scored(rows, lambda df: evaluate_documents(ask_model(df, Flaky, InferSettings(retries=1))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r.doc: (r.status[:5], r.exact_match) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": ("ok", 1.0), "none": ("ok", 0.0), "fail 9": ("error", None)}


def test_a_stream_that_follows_a_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = read_stream(spark, str(tmp_path / "in"), LOG_ENTRY)
    query = append_scored(stream, lambda rows: rows, str(tmp_path / "out"), str(tmp_path / "cp"), trigger={"processingTime": "0 seconds"})
    try:
        for step in (1, 2):
            (tmp_path / "in" / f"{step}.json").write_text(json.dumps({"step": step, "loss": 1.0}) + "\n")
            query.processAllAvailable()
            assert query.isActive and spark.read.parquet(str(tmp_path / "out")).count() == step
    finally:
        query.stop()


def test_training_monitor(spark, tmp_path):
    (tmp_path / "in").mkdir()
    prior = spark.createDataFrame([(1, None, 9.0, None, None, None), (12, None, 8.0, None, None, None)], LOG_ENTRY)
    refreshed = []

    class Watched(TrainingMonitor):
        def refresh(self, step, *more):
            refreshed.append(step)
            super().refresh(step, *more)

    def feed(step):
        (tmp_path / "in" / f"{step}.json").write_text(json.dumps({"step": step, "loss": float(step), "grad_norm": 1.0}) + "\n")
        monitor = Watched(str(tmp_path / "run"), prior, every=10)
        stream = read_stream(spark, str(tmp_path / "in"), LOG_ENTRY)
        monitor.start(stream, str(tmp_path / "cp")).awaitTermination()
        return monitor

    for step in (5, 9, 12, 18, 19):
        monitor = feed(step)
    # The first refresh is due at step every - 1, as the counter starts at -1.
    assert refreshed == [9, 19]
    monitor.finish()
    assert refreshed == [9, 19, 19]
    panels = monitor.panels()
    assert [(r.step, r.value) for r in panels.filter("tag = 'train_loss'").orderBy("step").collect()] == [(1, 9.0), (5, 5.0), (9, 9.0), (12, 12.0), (18, 18.0), (19, 19.0)]
    assert panels.filter("tag = 'train_loss' and step = 5").first().ema == pytest.approx(8.6)
    assert panels.filter("perplexity is not null").count() == 6
    assert TrainingMonitor(str(tmp_path / "x"), prior, every=0).start(None, "") is None


def same_points(got, want):
    rows = [sorted((tuple(r) for r in df.collect()), key=str) for df in (got, want)]
    assert [r[:3] for r in rows[0]] == [r[:3] for r in rows[1]]
    for a, b in zip(*rows, strict=True):
        assert [x is None for x in a] == [x is None for x in b]
        assert [x or 0.0 for x in a[3:]] == pytest.approx([x or 0.0 for x in b[3:]], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("late", [False, True])
def test_monitor_equals_smoothing_the_merged_history(spark, tmp_path, late):
    """Batch by batch: repeated steps, steps of the earlier run that are logged again or not, entries without a loss, one that comes late."""
    (tmp_path / "in").mkdir()
    prior = [(s, None, 5.0 + s % 3, 1.0 if s % 4 == 0 else None, 0.5, 0.1) for s in range(0, 60, 2)]
    batches = [
        [(20, None, 4.0, None, 0.25, 0.2), (21, None, 3.0, None, None, 0.2)],
        [(21, None, 2.5, None, 0.5, None), (None, 23, None, 0.75, 9.0, 9.0), (0, 24, 2.0, None, 0.5, 0.3)],
        [(30, None, 1.0, 0.5, None, None)],
        [(25, None, 7.0, None, None, None), (22, None, None, 0.25, None, None)] if late else [(31, None, 0.5, None, None, None)],
        [(58, None, 0.25, None, 2.0, None), (70, None, 0.125, None, 1.0, 0.4)],
    ]
    before = spark.createDataFrame(prior, LOG_ENTRY)
    monitor = TrainingMonitor(str(tmp_path / "run"), before, every=1)
    seen = []
    for n, rows in enumerate(batches):
        (tmp_path / "in" / f"{n}.json").write_text("".join(json.dumps(dict(zip(LOG_ENTRY.fieldNames(), r, strict=True))) + "\n" for r in rows))
        monitor.start(read_stream(spark, str(tmp_path / "in"), LOG_ENTRY), str(tmp_path / "cp")).awaitTermination()
        seen += rows
        if n in (0, 2, 4):
            same_points(monitor.panels(), panel_table(before, spark.createDataFrame(seen, LOG_ENTRY)))
    monitor.finish()
    same_points(monitor.panels(), panel_table(before, spark.createDataFrame(seen, LOG_ENTRY)))
    # What a batch writes depends on the batch and on what it has passed, not on how long the run is.
    assert spark.read.parquet(str(tmp_path / "run" / "points" / "batch=4")).count() < 4 * 4 + 4 * len(prior)


def test_a_batch_is_smoothed_without_a_task_per_series(spark, tmp_path):
    (tmp_path / "in").mkdir()
    prior = spark.createDataFrame([(s, None, 5.0 + s % 7, None, 1.0, None) for s in range(0, 900, 3)], LOG_ENTRY)
    rows = [(s, None, s % 11 / 8, s % 5 / 4, 0.5, None) for s in range(1, 600, 2)] * 2
    (tmp_path / "in" / "0.json").write_text("".join(json.dumps(dict(zip(LOG_ENTRY.fieldNames(), r, strict=True))) + "\n" for r in rows))
    monitor = TrainingMonitor(str(tmp_path / "run"), prior)
    query = monitor.start(read_stream(spark, str(tmp_path / "in"), LOG_ENTRY), str(tmp_path / "cp"))
    query.awaitTermination()
    # No keyed state, in which a series would be one key of one task.
    assert query.lastProgress["stateOperators"] == []
    monitor.finish()
    same_points(monitor.panels(), panel_table(prior, spark.createDataFrame(rows, LOG_ENTRY)))
