import hashlib
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatmill.operators import ordering as O
from chatmill.operators.combine import merge_sources, record_counts
from chatmill.operators.staging import shared_dir
from chatmill.operators.split import group_split, with_split


def test_numbering_is_a_total_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("id"), (F.col("id") % 3).alias("hot"))
    rows = O.number_rows(df.repartition(16), ["hot", "id"]).collect()
    assert sorted(r.row_no for r in rows) == list(range(5000))
    assert [(r.hot, r.id) for r in sorted(rows, key=lambda r: r.row_no)] == sorted((r.hot, r.id) for r in rows)


@pytest.mark.parametrize("partitions", [1, 8])
def test_shuffle_is_a_fixed_permutation(spark, partitions):
    df = spark.range(1000).repartition(partitions)
    got = [r.id for r in O.seeded_shuffle(df, 42, ["id"], partitions).collect()]
    assert got == sorted(range(1000), key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
    assert [r.id for r in O.seeded_shuffle(df, 43, ["id"], partitions).collect()] != got


def test_cap(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("id"))
    assert [r.id for r in O.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert O.first_rows(df, ["id"], None).count() == 100
    with pytest.raises(ValueError):
        O.first_rows(df, ["id"], 0)
    assert [r.id for r in O.first_rows(df, ["id"], 40).collect()] == list(range(40))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from([0.5, 1.0, 1.0, 2.25, 7.0, -3.0]), min_size=1, max_size=30))
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert O.exact_median(df, "v").first()[0] == statistics.median(values)


def test_median_of_nothing(spark):
    assert O.exact_median(spark.createDataFrame([], "v double"), "v").first()[0] is None


@pytest.mark.parametrize("groups, share", [(25, 0.1), (35, 0.1), (5, 0.01), (3, 0.5), (200, 0.333)])
def test_split_is_exact_and_keeps_groups(spark, groups, share):
    # One group holds a third of all rows.
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % groups).alias("g"), "id")
    train, evaluation = group_split(rows, "g", share, seed=1)
    a, b = ({r.g for r in side.select("g").distinct().collect()} for side in (train, evaluation))
    assert not a & b and len(a | b) == groups and len(b) == max(1, round(groups * share))
    assert train.count() + evaluation.count() == 3000
    by_hash = sorted(range(groups), key=lambda g: (hashlib.md5(f"1|{g}".encode()).hexdigest(), str(g)))
    assert b == set(by_hash[: len(b)])


def test_split_labels_rows_without_moving_them(spark):
    plan = with_split(spark.range(100).withColumn("g", F.col("id") % 10), "g", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Subquery" not in plan
    with pytest.raises(ValueError):
        with_split(spark.range(0).withColumn("g", F.lit("x")), "g", 0.2)


def test_split_refuses_an_empty_side(spark):
    df = spark.range(10).withColumn("g", F.lit("same"))
    with pytest.raises(Exception, match="train split would be empty"):
        with_split(df, "g", 0.5).collect()
    for share in (0, 1, -1):
        with pytest.raises(ValueError):
            with_split(df, "g", share)


def test_merge(spark):
    a, b = spark.createDataFrame([("x", 1), ("x", 1)], "line string, n int"), spark.createDataFrame([("y",)], "line string")
    merged = merge_sources({"a": a, "b": b, "c": a})
    assert sorted((r.source_no, r.source, r.line, r.n) for r in merged.collect() if r.n) == [(0, "a", "x", 1)] * 2 + [(2, "c", "x", 1)] * 2
    assert {(r.source, r.records) for r in record_counts(merged).collect()} == {("a", 2), ("b", 1), ("c", 2), ("total", 5)}
    with pytest.raises(ValueError):
        merge_sources({})


def test_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
            self.conf = Conf({"spark.checkpoint.dir": v for v in conf.values()})

    assert shared_dir(Session("spark://host", folder="hdfs:///cp/")) == "hdfs:///cp"
    assert shared_dir(Session("local[2]")) == shared_dir(Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))
