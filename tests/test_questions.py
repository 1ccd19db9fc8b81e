import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatmill.functions.options import expand_questions
from chatmill.functions.qa import parse_qa, qa_samples
from chatmill.plans.documents import document_dataset, document_records, document_tasks


def expand(spark, templates):
    df = spark.createDataFrame(list(enumerate(templates)), "i int, question string")
    rows = expand_questions(df).orderBy("i", "option_no").collect()
    return [[r.question for r in rows if r.i == i] for i in range(len(templates))]


def test_examples(spark):
    cases = {
        "Who {wrote, sent, _} it?": ["Who wrote it?", "Who sent it?", "Who it?"],
        "From {A, B} to {C, D}": ["From A to C", "From A to D", "From B to C", "From B to D"],
        " {} two  spaces ": ["{} two  spaces"],
        "{a{b}} {b}": ["a b {b}"],
        "{a,a}": ["a", "a"],
        "{x,y} {x,y}": ["x x", "x y", "y x", "y y"],
        "no block": ["no block"],
        "{ , _}!": ["!", "!"],
        "{ä b ,c}d  e": ["ä bd e", "cd e"],
    }
    assert expand(spark, list(cases)) == list(cases.values())


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.lists(st.sampled_from(["a", "b", "_", "ä x"]), min_size=1, max_size=4), max_size=3), min_size=20, max_size=20))
def test_expansion_counts_and_order(spark, shapes):
    templates = [" / ".join("{" + ",".join(options) + "}" for options in blocks) for blocks in shapes]
    for blocks, got in zip(shapes, expand(spark, templates), strict=True):
        assert len(got) == math.prod(map(len, blocks))
        if blocks:
            # The last block varies fastest, so its options come in turn at the end of the questions.
            turn = ["" if o == "_" else o for o in blocks[-1]]
            assert all(q.endswith(turn[i % len(turn)]) for i, q in enumerate(got))


def test_a_huge_product_is_counted(spark):
    template = " ".join("{" + ",".join(str(j) for j in range(100)) + "}" for _ in range(3)) + " {a,b,c,d}"
    out = expand_questions(spark.createDataFrame([(template,)], "question string"))
    assert out.select("option_no").count() == 4_000_000


def test_large_product(spark):
    template = " ".join("{" + ",".join(f"w{i}{j}" for j in range(10)) + "}" for i in range(4))
    df = spark.createDataFrame([(template,)], "question string")
    out = expand_questions(df)
    assert out.select("question").distinct().count() == 10_000
    assert out.filter("option_no = 1234").first().question == "w01 w12 w23 w34"


QA = "> Q1 {a, _}?\nA1\n\nA1b  \n--  \n\n\n> Q2\n\n\nA2\r\n--\r\nbad line\nx\n--\n> Q3\n--\n\n> Q4 A4\n--\n> \nanswer\n--\n >Q5\nx\n---\n"


def test_parse(spark):
    good, bad = parse_qa(spark.createDataFrame([("d", QA)], "stem string, qa_text string"))
    assert [(r.block_no, r.question, r.answer) for r in good.orderBy("block_no").collect()] == [(0, "Q1 {a, _}?", "A1\n\nA1b"), (1, "Q2", "A2")]
    faults = [(r.block_no, r["head"], r.fault) for r in bad.orderBy("block_no").collect()]
    assert faults == [
        (2, "bad line", "no question prefix"),
        (3, "> Q3", "no answer"),
        (4, "> Q4 A4", "no answer"),
        (5, ">", "no question prefix"),
        (6, " >Q5", "no question prefix"),
    ]


def parse_by_hand(text):
    out = []
    for block in re.split(r"^--\s*$", text.replace("\r\n", "\n").replace("\r", "\n"), flags=re.MULTILINE):
        lines = [x.rstrip() for x in block.splitlines()]
        body = "\n".join(lines).strip("\n")
        head, _, rest = body.partition("\n")
        if head.startswith("> ") and rest.strip("\n"):
            out.append((head[2:], rest.strip("\n")))
    return out


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="> -\n\r\tab  ", max_size=40), min_size=40, max_size=40))
def test_parse_agrees_with_the_direct_way(spark, texts):
    good, _ = parse_qa(spark.createDataFrame(list(enumerate(texts)), "i int, qa_text string"))
    rows = good.orderBy("i", "block_no").collect()
    for i, text in enumerate(texts):
        assert [(r.question, r.answer) for r in rows if r.i == i] == parse_by_hand(text), repr(text)


def _docs(spark, n=40):
    docs = spark.createDataFrame([(f"d{i:02}", f" Text {i}\n") for i in range(n)], "stem string, content string")
    qa = spark.createDataFrame([(f"d{i:02}", QA) for i in range(n - 1)] + [("orphan", QA)], "stem string, qa_text string")
    return docs, qa


def test_document_records(spark):
    records = document_records(*_docs(spark), preamble="P:")
    rows = records.orderBy("stem", "block_no", "option_no").collect()
    assert len(rows) == 39 * 3 == qa_samples(_docs(spark)[1]).count() - 3
    first = rows[0].conversations
    assert [(t.role, t.content) for t in first] == [("system", "P: Text 0\n"), ("user", "Q1 a?"), ("assistant", "A1\n\nA1b")]


def test_document_dataset_keeps_documents_together(spark):
    train, evaluation = document_dataset(*_docs(spark), share=0.1, seed=7)
    sides = [{r.stem for r in side.select("stem").distinct().collect()} for side in (train, evaluation)]
    assert not sides[0] & sides[1] and len(sides[1]) == 4 and len(sides[0]) == 35
    everything, none = document_dataset(*_docs(spark))
    assert none is None and everything.count() == train.count() + evaluation.count()
    stems = [r.stem for r in everything.collect()]
    assert stems == sorted(stems) and [r.stem for r in train.collect()] != sorted(r.stem for r in train.collect())


def test_task_cap_counts_questions(spark):
    tasks = document_tasks(*_docs(spark), max_samples=4).orderBy("doc", "block_no", "option_no")
    assert [(r.doc, r.question) for r in tasks.collect()] == [("d00", "Q1 a?"), ("d00", "Q1 ?"), ("d00", "Q2"), ("d01", "Q1 a?")]
    assert tasks.filter(F.col("ground_truth") == "A2").count() == 1
