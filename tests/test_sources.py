import json
import os
from hashlib import md5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatmill.functions.chat import ChatTemplate, is_multimodal, render, render_batch
from chatmill.operators.conversations import multimodal_route
from chatmill.operators.report import document_summary
from chatmill.plans.evaluation import profile_tasks
from chatmill.plans.merge import merge_files
from chatmill.schemas import DOC_RESULT
from chatmill.sources import jsonl, logs, sinks
from chatmill.sources.folders import read_documents, read_sample_folders

RECORDS = [
    {"conversations": [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": "Hello"}]},
    {"conversations": [{"role": "system", "content": "S"}, {"role": "user", "content": "[1, 2]"}, {"role": "assistant", "content": '{"a": 1}'}]},
    {"conversations": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "<think>x</think>b"}, {"role": "user", "content": "ä\n\"q\""}]},
    {"conversations": [{"role": "assistant", "content": '<tool_call>{"n": 1}</tool_call>'}, {"role": "tool", "content": "<tool_response>1</tool_response>"}]},
    {"conversations": [{"role": "user", "content": [{"type": "image", "image": "i.png"}, {"type": "text", "text": "What?"}]}, {"content": "no role"}]},
    {"conversations": []},
    {"other": 1},
]


@pytest.fixture
def jsonl_file(tmp_path):
    path = tmp_path / "records.jsonl"
    path.write_text("\n \n".join(json.dumps(r, ensure_ascii=False) for r in RECORDS) + "\n", encoding="utf-8")
    return str(path)


def test_strict_reader(spark, jsonl_file):
    got = jsonl.read_conversations(spark, jsonl_file).orderBy("file", "seq").collect()
    assert [[(t.role, t.content) for t in r.conversations] for r in got] == [
        [(t.get("role"), t["content"] if isinstance(t["content"], str) else None) for t in r.get("conversations", [])] for r in RECORDS
    ]
    parts = got[4].conversations[0].parts
    assert [(p.type, p.image, p.text) for p in parts] == [("image", "i.png", None), ("text", None, "What?")]
    assert got[1].conversations[1].parts is None


def test_strict_reader_fails_on_a_bad_line(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"conversations": []}\n{"conversations": [}\n')
    with pytest.raises(Exception, match="malformed line"):
        jsonl.read_conversations(spark, str(path)).collect()


def test_tolerant_reader_names_the_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\noops\n  {"y": [2]}  \n')
    (tmp_path / "b.jsonl").write_text('{"z": 3}\n{"z": 3} tail\n')
    good, bad = jsonl.read_tolerant(spark, str(tmp_path))
    assert sorted(r.line for r in good.collect()) == ['{"x": 1}', '{"y": [2]}', '{"z": 3}']
    assert sorted((r.file[-7:], r.line_no, r.line) for r in bad.collect()) == [("a.jsonl", 3, "oops"), ("b.jsonl", 2, '{"z": 3} tail')]


def test_merge_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f'{{"n": {i}}}\n' for i in range(50)) + "broken\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text('{"any": "key", "n": 1}\n{"n": 0}\n')
    paths = [str(tmp_path / n) for n in ("a.jsonl", "b.jsonl")]
    plain = [r.line for r in merge_files(spark, paths).collect()]
    assert plain == [f'{{"n": {i}}}' for i in range(50)] + ['{"any": "key", "n": 1}', '{"n": 0}']
    mixed = [r.line for r in merge_files(spark, paths, shuffle_seed=42).collect()]
    assert sorted(mixed) == sorted(plain) and mixed != plain
    assert mixed == [r.line for r in merge_files(spark, paths, shuffle_seed=42).collect()]
    sinks.write_lines(merge_files(spark, paths), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 52
    with pytest.raises(FileNotFoundError):
        merge_files(spark, [*paths, str(tmp_path / "none")])


def test_round_trip(spark, jsonl_file, tmp_path):
    records = jsonl.read_conversations(spark, jsonl_file)
    sinks.write_conversations(records.orderBy("file", "seq"), str(tmp_path / "out" / "deep"))
    back = jsonl.read_conversations(spark, str(tmp_path / "out" / "deep"))
    assert [r.conversations for r in back.orderBy("file", "seq").collect()] == [r.conversations for r in records.orderBy("file", "seq").collect()]
    lines = [r.value for r in spark.read.text(str(tmp_path / "out" / "deep")).collect()]
    assert json.dumps(RECORDS[2], ensure_ascii=False) in lines and json.dumps(RECORDS[4], ensure_ascii=False) in [x.replace('{"content": "no role"}', '{"content": "no role"}') for x in lines]


def test_modality_and_rendering(spark, jsonl_file):
    records = jsonl.read_conversations(spark, jsonl_file)
    c = F.col("conversations")
    assert [r[0] for r in records.orderBy("file", "seq").select(is_multimodal(c)).collect()] == [False] * 4 + [True, False, False]
    assert multimodal_route(records).first()[0] == "multimodal" and multimodal_route(records.limit(0)).first()[0] == "text"
    texts = [r[0] for r in records.orderBy("file", "seq").select(render(c)).collect()]
    assert texts[0] == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nHello<|im_end|>\n"
    prompt = records.orderBy("file", "seq").select(render(c, ChatTemplate("[", ":", "]"), add_generation_prompt=True)).first()[0]
    assert prompt == "[user:Hi][assistant:Hello][assistant:"
    both = records.filter(F.size(c) == 2).limit(1).select(render_batch(F.array(c, c)).alias("b"), render(c).alias("r")).first()
    assert both.b == [both.r, both.r]


def test_load_train_eval(spark, jsonl_file, tmp_path):
    train, evaluation = jsonl.load_train_eval(spark, jsonl_file, str(tmp_path / "missing.jsonl"), max_samples=2)
    assert train.count() == 2 and evaluation is None
    train, evaluation = jsonl.load_train_eval(spark, jsonl_file, jsonl_file)
    assert train.count() == evaluation.count() == 7


def test_tasks_from_records(spark, jsonl_file):
    tasks = profile_tasks(spark, records=jsonl_file).collect()
    by_name = {r["sample"]: (r.question, r.ground_truth) for r in tasks}
    assert by_name["sample_1"] == ("[1, 2]", '{"a": 1}') and by_name["sample_2"] == ('ä\n"q"', "{}") and by_name["sample_5"] == ("", "{}")
    assert len(by_name) == 7 and profile_tasks(spark, records=jsonl_file, max_samples=3).count() == 3
    for wrong in ({}, {"folder": "x", "records": "y"}):
        with pytest.raises(ValueError):
            profile_tasks(spark, **wrong)


def test_documents(spark, tmp_path):
    for name, text in {"a.b.md": "A\r\n", "a.b.txt": "> Q\nx", "c.md": "C", "d.txt": "D", "e.TXT": "E"}.items():
        (tmp_path / name).write_text(text, newline="")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.md").write_text("Z")
    docs, qa = read_documents(spark, str(tmp_path))
    assert sorted(map(tuple, docs.collect())) == [("a.b", "A\n"), ("c", "C")]
    assert sorted(map(tuple, qa.collect())) == [("a.b", "> Q\nx"), ("d", "D")]


@pytest.mark.parametrize("langs", [True, False])
def test_sample_folders(spark, tmp_path, langs):
    files = {"p 1/x.md": "T1 ", "p 1/y.json": '{"a": 1}', "p 1/y_metadata.json": "{}", "q/x.md": "T2", "r/x.json": "[]", "s/b.md": "B", "s/a.md": "A", "s/z.json": "no", "s/deep/n.md": "N"}
    for base in ("de", "en", "fr") if langs else ("",):
        for name, text in files.items():
            path = tmp_path / base / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
    pairs, rejects = read_sample_folders(spark, str(tmp_path))
    found = {(r.lang, r["sample"]): (r.cv_text, r.json_text) for r in pairs.collect()}
    assert {k for k, _ in found} == ({"de", "en"} if langs else {""})
    lang = "de" if langs else ""
    assert found[(lang, "p 1")] == ("T1", '{"a": 1}') and found[(lang, "s")] == ("A", "no")
    assert {(r["sample"], r.fault) for r in rejects.collect()} == {("q", "no json file"), ("r", "no text file")}
    tasks = profile_tasks(spark, folder=str(tmp_path)).collect()
    assert {r["sample"] for r in tasks} == {"p 1"} and len(tasks) == (2 if langs else 1)


@pytest.mark.parametrize("form", ["absolute", "uri", "relative"])
def test_roots_and_names(spark, tmp_path, monkeypatch, form):
    for sample in ("a b", "a+b", "a%20b", "ü"):
        (tmp_path / "root" / sample).mkdir(parents=True)
        (tmp_path / "root" / sample / "x.md").write_text(f"{sample}\r\nend\r", newline="")
        (tmp_path / "root" / sample / "x.json").write_text("{}")
    root = {"absolute": str(tmp_path / "root"), "uri": f"file://{tmp_path}/root", "relative": os.path.relpath(tmp_path / "root")}[form]
    pairs, rejects = read_sample_folders(spark, root)
    assert sorted((r["sample"], r.cv_text) for r in pairs.collect()) == sorted((s, f"{s}\nend") for s in ("a b", "a+b", "a%20b", "ü"))
    assert rejects.count() == 0
    docs, _ = read_documents(spark, f"{root}/a+b")
    assert docs.collect()[0].stem == "x"


def test_hidden_names_are_rows(spark, tmp_path):
    for name in ("s/_n.md", "s/.p%20q.md", "s/a b+c.md", "s/_n.txt", ".t/x.md", ".t/_y.json", "u/x.md", "u/_x_metadata.json", "u/deep/_z.json", "_v/.w.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(b"one\r\ntwo\rthree")
    docs, texts = read_documents(spark, str(tmp_path / "s"))
    assert {(r.stem, r.content) for r in docs.collect()} == {(n, "one\ntwo\nthree") for n in ("_n", ".p%20q", "a b+c")}
    assert [r.stem for r in texts.collect()] == ["_n"]
    pairs, rejects = read_sample_folders(spark, str(tmp_path))
    assert [(r["sample"], r.cv_text, r.json_text) for r in pairs.collect()] == [(".t", "one\ntwo\nthree", "one\ntwo\nthree")]
    assert {(r["sample"], r.fault) for r in rejects.collect()} == {("s", "no json file"), ("u", "no json file"), ("_v", "no text file")}
    (tmp_path / "s" / "_n.md").rename(tmp_path / "s" / "n.md")
    (tmp_path / "s" / ".p%20q.md").rename(tmp_path / "s" / "p%20q.md")
    assert {r.stem for r in read_documents(spark, f"file:{tmp_path}/s")[0].collect()} == {"n", "p%20q", "a b+c"}


def test_hidden_files_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    from chatmill.sources import hidden

    for i in range(25):
        (tmp_path / f"_{i}.md").write_text("x" * 100)
    monkeypatch.setattr(hidden, "TASK_BYTES", 1000)
    reader = hidden.HiddenFilesReader({"roots": json.dumps([str(tmp_path), str(tmp_path / "missing")]), "suffix": ".md"})
    groups = reader.partitions()
    assert [len(g.paths) for g in groups] == [10, 10, 5]
    assert sum(len(list(reader.read(g))) for g in groups) == 25


def test_only_the_last_log_file_is_read(spark, tmp_path):
    for name in ("a/2.json", "b/1.json"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(json.dumps({"tag": name, "step": 1, "value": 1.0}) + "\n")
    got = logs.read_scalars(spark, str(tmp_path))
    assert [r.tag for r in got.collect()] == ["b/1.json"]
    assert len(got.inputFiles()) == 1
    assert logs.read_scalars(spark, str(tmp_path / "a" / "none")).count() == 0 if (tmp_path / "a" / "none").mkdir() is None else False


ODD_LINES = [
    '{"conversations": [{"role": "user", "content": "first", "content": "last"}]}',
    '{"n": NaN, "conversations": [{"role": "user", "content": "nan"}, {"role": "user", "content": [{"type": "image_url", "image_url": {"url": "u"}}]}]}',
    '{"conversations": [{"role": "user", "content": "plain"}, {"role": "user", "content": [{"type": "image_url", "image_url": {"url": "u"}}, {"type": "text", "text": "t"}]}]}',
]


def test_lines_that_only_python_reads(spark, tmp_path):
    path = tmp_path / "odd.jsonl"
    path.write_text("\n".join(ODD_LINES) + "\n")
    got = [r.conversations for r in jsonl.read_conversations(spark, str(path)).orderBy("seq").collect()]
    assert [t[0].content for t in got] == ["last", "nan", "plain"]
    parts = got[2][1].parts
    assert json.loads(parts[0].json) == {"type": "image_url", "image_url": {"url": "u"}} and (parts[1].text, parts[1].json) == ("t", None)
    assert json.loads(got[1][1].parts[0].json) == json.loads(parts[0].json)
    good, bad = jsonl.read_tolerant(spark, str(path))
    assert good.count() == 3 and bad.count() == 0


def test_a_very_long_text(spark, tmp_path):
    path = tmp_path / "long.jsonl"
    path.write_text(json.dumps({"conversations": [{"role": "user", "content": "x" * 21_000_000}]}) + "\n")
    assert jsonl.read_conversations(spark, str(path)).select(F.length(F.col("conversations")[0]["content"])).first()[0] == 21_000_000
    assert jsonl.read_tolerant(spark, str(path))[0].count() == 1


def test_a_bad_line_fails_any_use(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"conversations": []}\n{"conversations": [}\n')
    with pytest.raises(Exception, match="malformed line"):
        jsonl.read_conversations(spark, str(path)).count()


def test_logs_cut_off_by_a_crash(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"tag": "loss", "step": 1, "value": 0.5}\n\n{"tag": "loss", "step": 2, "va')
    assert [(r.tag, r.step, r.value) for r in logs.read_scalars(spark, str(tmp_path / "log")).collect()] == [("loss", 1, 0.5)]
    (tmp_path / "res.json").write_text('{"doc": "d", "status": "ok"}\n{"_summary": true}\n{"doc": "e", "stat')
    assert [r.doc for r in logs.read_results(spark, str(tmp_path / "res.json"), DOC_RESULT).collect()] == ["d"]


def test_split_sink(spark, jsonl_file, tmp_path):
    records = jsonl.read_conversations(spark, jsonl_file)
    out = str(tmp_path / "train.jsonl")
    assert sinks.write_split(records, records.limit(2), out) == str(tmp_path / "train_eval.jsonl")
    assert spark.read.text(str(tmp_path / "train_eval.jsonl")).count() == 2
    with pytest.raises(ValueError, match="nothing is written"):
        sinks.write_split(records, records.limit(0), out)
    assert sinks.eval_path("data") == "data_eval"
    assert sinks.dry_run(records.withColumn("source", F.lit("a"))).count() == 2


def test_result_log(spark, tmp_path):
    path = str(tmp_path / "log")
    row = {f: None for f in DOC_RESULT.fieldNames()} | {"doc": "d", "status": "ok", "latency_s": 1.0, "token_f1": 0.5}
    rows = spark.createDataFrame([tuple(row.values())], DOC_RESULT)
    sinks.append_results(rows, path)
    sinks.append_results(rows, path)
    assert '"rougeL_f":null' in spark.read.text(path).first()[0]
    (tmp_path / "log" / "summary.json").write_text('{"_summary": true, "n_total": 2}\n')
    results = logs.read_results(spark, path, DOC_RESULT)
    summary = document_summary(results).first()
    assert (summary.n_total, summary.n_ok, summary.latency_median_s, summary.rougeL_f_mean) == (2, 2, 1.0, None)
    tasks = spark.createDataFrame([("d",), ("e",)], "doc string")
    assert [r.doc for r in sinks.unfinished(tasks, results, "doc").collect()] == ["e"]


def test_scalars(spark, tmp_path):
    for name, rows in {"run1/events.1": [(1, 1.0), (2, 2.0)], "run2/events.2": [(2, 5.0), (3, 3.0)]}.items():
        path = tmp_path / f"{name}.json"
        path.parent.mkdir()
        path.write_text("".join(json.dumps({"tag": "train/loss", "step": s, "value": v}) + "\n" for s, v in rows))
    assert sorted(map(tuple, logs.read_scalars(spark, str(tmp_path)).collect())) == [("train/loss", 2, 5.0), ("train/loss", 3, 3.0)]
    assert sorted(r.value for r in logs.read_scalars(spark, str(tmp_path), merge_runs=True).collect()) == [1.0, 3.0, 5.0]


def test_checkpoint_history(spark, tmp_path):
    assert logs.read_checkpoint_history(spark, str(tmp_path)).count() == 0
    for n in (9, 10):
        (tmp_path / f"checkpoint-{n}").mkdir()
        (tmp_path / f"checkpoint-{n}" / "trainer_state.json").write_text(json.dumps({"log_history": [{"step": n, "loss": 1.5}, {"step": n, "eval_loss": 2}]}, indent=1))
    assert [(r.step, r.loss, r.eval_loss) for r in logs.read_checkpoint_history(spark, str(tmp_path)).collect()] == [(10, 1.5, None), (10, None, 2.0)]
    (tmp_path / "checkpoint-11").mkdir()
    assert logs.read_checkpoint_history(spark, str(tmp_path)).count() == 0


def test_the_driver_lists_no_small_files(spark, tmp_path):
    for i in range(300):
        (tmp_path / "en" / f"{i}").mkdir(parents=True)
        (tmp_path / "en" / f"{i}" / "a.md").write_text(f"text {i}")
        (tmp_path / "en" / f"{i}" / "a.json").write_text(f"[{i}]")
        (tmp_path / "en" / f"{i}.md").write_text(f"text {i}")
    (tmp_path / "en" / "empty.md").touch()
    docs, texts = read_documents(spark, str(tmp_path / "en"))
    pairs, rejects = read_sample_folders(spark, str(tmp_path))
    for df in (docs, texts, pairs, rejects):
        assert df.inputFiles() == []
    assert docs.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.stem, r.content) for r in docs.collect()} == {(str(i), f"text {i}") for i in range(300)} and texts.count() == 0
    assert {(r.lang, r["sample"], r.cv_text, r.json_text) for r in pairs.collect()} == {("en", str(i), f"text {i}", f"[{i}]") for i in range(300)}
    assert rejects.count() == 0
    assert {r.stem for r in read_documents(spark, f"{tmp_path}/e*")[0].collect()} == {str(i) for i in range(300)}
    with pytest.raises(FileNotFoundError):
        read_documents(spark, str(tmp_path / "none"))


def test_an_empty_side_is_found_before_the_other_is_made(spark, jsonl_file, tmp_path):
    records = jsonl.read_conversations(spark, jsonl_file)
    made = records.withColumn("conversations", F.when(F.raise_error(F.lit("made")).isNull(), F.col("conversations")))
    with pytest.raises(ValueError, match="nothing is written"):
        sinks.write_split(made, records.limit(0), str(tmp_path / "train.jsonl"))
    assert not [p for p in os.listdir(tmp_path) if "train" in p]


def test_a_large_table_of_samples_is_never_on_disk_as_a_whole(spark, tmp_path, monkeypatch):
    from chatmill.queries import QUERIES, files
    from chatmill.sources.files import mounted_path

    # One row twice, one without a key: its files lie in no folder of a sample.
    ids = [*range(1, 121), 7, None]
    rows = [(i, f" text {i}\r\nend ", None if i is None or i % 5 == 0 else ("de", "en", "fr")[i % 3]) for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    shared = Path(mounted_path(spark.conf.get("spark.checkpoint.dir")))
    held = []

    def read(session, root):
        held.append(len([p for p in shared.glob("chatmill/*/samples-*/*/*/*") if p.stat().st_size]))
        return read_sample_folders(session, root)

    monkeypatch.setattr(files, "read_sample_folders", read)
    monkeypatch.setattr(files, "TREE_BYTES", 512 << 10, raising=False)
    got = QUERIES["folder_samples"](spark, str(tmp_path)).collect()
    expected = {("de" if lang == "de" else "en", str(i), md5(f"text {i}\nend".encode()).hexdigest(), f'{{"id": {i}}}') for i, _, lang in rows if i and i % 11 != 3}
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(held) == 3 * 120 - len([i for i in range(1, 121) if i % 11 == 3]) and max(held) < sum(held) / 2
    assert not [p for p in shared.glob("chatmill/*/samples-*/*/*/*") if p.stat().st_size]
