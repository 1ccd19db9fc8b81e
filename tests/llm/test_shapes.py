"""Empty tables, nulls, repeated rows, odd texts and clashing column names, for every operator and every pipeline stage."""

import pytest
from pyspark.sql import functions as F

from chatmill.llm.caps import near_vectors
from chatmill.llm.minhash import drop_near_duplicates, near_duplicates
from chatmill.llm.mixing import Mix
from chatmill.llm.pii import with_pseudonyms
from chatmill.llm.projected import nearest
from chatmill.llm.secret_scan import with_secrets
from chatmill.llm.suffix_tree import score_corpus
from chatmill.llm.toxicity import drop_toxic, score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, size int, sid int, strength int, secrets int"
LONG = "word" * 30_000 + " " + "ab cd " * 20_000
ROWS = [
    (1, "one two three four five six", "en", "a", 27, 1, "k", 1, 1, 1, 1),
    (1, "one two three four five six", "en", "a", 27, 1, "k", 1, 1, 1, 1),
    (2, "One Two\tthree\nfour five SIX", "en", "b", 27, 1, "k", 1, 1, 1, 1),
    (3, None, None, None, None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, 1, "k", 1, 1, 1, 1),
    (5, " \t\n", "en", None, 3, 1, "k", 1, 1, 1, 1),
    (None, "one two three four five six", "en", "a", 27, 1, "k", 1, 1, 1, 1),
    (6, LONG, "en", "b", len(LONG), 1, "k", 1, 1, 1, 1),
    (7, "é 😀 only", "fr", "", 8, 1, "k", 1, 1, 1, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, None), (None, 1), (99, 1)], "doc_id long, toxic int")


def test_near_duplicates(docs):
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    assert len(got) == len(ROWS)
    assert {r[:4] for r in got if r[0] in (1, 2)} == {(1, 2, 1, True), (2, 2, 1, False)}
    assert {r for r in got if r[0] in (3, 4, 5)} == {(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)}
    assert [r for r in got if r[0] is None] == [(None, 2, None, True)]
    assert near_duplicates(docs.limit(0)).collect() == []
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]


def test_pipeline_drops_copies_that_share_80_percent(spark):
    import corpus_pipeline

    first = [f"w{i}" for i in range(94)]  # 90 shingles
    texts = [first, [*first[:84], *(f"y{i}" for i in range(10))], [*first[:60], *(f"z{i}" for i in range(34))]]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    shared = [len(a & b) / len(a | b) for a, b in ((sets[0], sets[1]), (sets[0], sets[2]), (sets[1], sets[2]))]
    assert 0.8 <= shared[0] < 0.85 and max(shared[1:]) < 0.7
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, "").collect()) == [0, 2]


def test_toxicity(docs, labels):
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(got) == 8 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert score_toxicity(docs.limit(0), labels).collect() == []
    assert score_toxicity(docs, labels.limit(0)).count() == len(ROWS)
    assert drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert drop_toxic(docs.limit(0), labels).collect() == []


def test_pseudonyms(docs):
    got = with_pseudonyms(docs, "k").collect()
    assert sorted(map(str, got)) == sorted(map(str, docs.collect()))  # nothing private here
    assert with_pseudonyms(docs.limit(0), "k").collect() == []


def test_secrets(docs):
    got = with_secrets(docs)
    assert got.columns == docs.columns
    assert all(r.secrets == [] for r in got.collect())
    assert with_secrets(docs.limit(0)).collect() == []


def test_suffix_tree(docs):
    got = score_corpus(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.score < 0 and r.base_score < 0 and r.n_tokens >= 1 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert score_corpus(docs.limit(0)).collect() == []


def test_mixing(docs):
    mix = Mix(docs, keep=True)
    got = mix.words_taken().collect()
    assert len(got) == len(ROWS) and all(r.taken <= 3 * r.size for r in got)
    assert all(r.size == r.taken == 0 for r in got if r.key in (3, 4, 5))
    assert mix.texts().columns == docs.columns
    assert {r.doc_id for r in mix.texts().collect()} <= {1, 2, 6, 7, None}
    empty = Mix(docs.limit(0), keep=True)
    assert empty.words_taken().collect() == [] and empty.texts().collect() == []


VECTORS = [
    (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [1.0, 0.001, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0]),
    (7, [float("inf"), 1.0, 0.0]), (8, [None, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (9, [0.0, 1.0, 0.0]), (9, [0.0, 1.0, 0.0]), (50, [0.0, 1.0, 0.0]), (100, [-1.0, 0.0, -0.0]),
]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(k, v, 1, 2) for k, v in VECTORS], "vec_id long, embedding array<double>, id int, copies int")


def test_near_vectors(vectors):
    got = sorted((tuple(r) for r in near_vectors(vectors).collect()), key=str)
    want = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *[(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8)], (None, 0, None, True), (9, 2, 9, True), (9, 2, 9, True), (50, 2, 9, False), (100, 0, 100, True)]
    assert got == sorted(want, key=str)
    assert near_vectors(vectors.limit(0)).collect() == []
    assert near_vectors(vectors.filter(F.col("embedding").isNull())).count() == 1


def test_nearest(vectors):
    got = nearest(vectors)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    by = {q: [(r.rank, r.vec_id, round(r.score, 6)) for r in sorted(got.collect(), key=lambda r: r.rank) if r.query_id == q] for q in (50, 100)}
    assert by[50] == [(1, 9, 1.0), (2, 9, 1.0), (3, 2, 0.001), (4, 1, 0.0), (5, 2, 0.0)]
    assert [x[1] for x in by[100]] == [9, 9, 50, 2, 1]
    assert nearest(vectors.limit(0)).collect() == []
    assert nearest(vectors.filter("vec_id < 50")).collect() == []


def test_unequal_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0]), (50, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        near_vectors(df)


def test_pipeline_stages(spark, docs, labels, tmp_path):
    import corpus_pipeline

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, plain.limit(0), str(tmp_path)).collect() == [], name
        if name != "tokens":
            assert step(spark, plain, str(tmp_path)).columns == plain.columns
