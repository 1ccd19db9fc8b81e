import math

import pytest
from pyspark.sql import functions as F

from chatmill.operators import trainlog as L
from chatmill.schemas import LOG_ENTRY


def smooth(values, alpha):
    out = []
    for v in values:
        out.append(alpha * v + (1 - alpha) * out[-1] if out else v)
    return out


@pytest.mark.parametrize("alpha", [0.1, 0.2, 1.0, 0.001])
def test_ema_over_many_slices(spark, alpha):
    # One series holds most rows and is cut into several slices; others have one or two points.
    rows = [("hot", i * 3, math.sin(i) * 5 + 100 * (i == 0)) for i in range(4000)] + [(f"t{i}", s, float(i + s)) for i in range(50) for s in range(1 + i % 2)]
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        df = spark.createDataFrame(rows, "tag string, step bigint, value double").repartition(5)
        got = L.ema(df, alpha=alpha).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert len(got) == len(rows)
    for tag in {t for t, _, _ in rows}:
        series = sorted((r.step, r.ema) for r in got if r.tag == tag)
        assert [e for _, e in series] == pytest.approx(smooth([v for t, _, v in rows if t == tag], alpha), abs=1e-9)


def test_ema_after_nan(spark):
    df = spark.createDataFrame([("a", i, float("nan") if i == 3 else 1.0) for i in range(6)], "tag string, step bigint, value double")
    for partitions in (1, 3):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        got = [r.ema for r in L.ema(df).orderBy("step").collect()]
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.enabled", True)
        assert got[:3] == [1.0] * 3 and all(math.isnan(x) for x in got[3:])
    assert got[:3] == [1.0] * 3 and all(math.isnan(x) for x in got[3:])
    assert L.ema(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.ema(df, alpha=0)


def test_perplexity(column):
    assert column(L.perplexity, [0.0, 1.0, 20.0, 50.0], "double") == pytest.approx([1.0, math.e, math.exp(20), math.exp(20)])


@pytest.fixture
def scalars(spark):
    rows = [
        ("f1", "train/loss", 1, 1.0, 0), ("f1", "train/loss", 2, 2.0, 1), ("f1", "train/loss", 2, 2.5, 2), ("f1", "eval_loss", 1, 9.0, 3),
        ("f2", "train/loss", 2, 3.0, 4), ("f2", "train/loss", 5, 0.5, 5), ("f2", "eval_loss", 6, 8.0, 6),
    ]
    return spark.createDataFrame(rows, "file string, tag string, step bigint, value double, seq bigint")


def test_series(scalars):
    merged = L.dedup_series(scalars)
    points = sorted(map(tuple, merged.collect()))
    assert points == [("eval_loss", 1, 9.0), ("eval_loss", 6, 8.0), ("train/loss", 1, 1.0), ("train/loss", 2, 3.0), ("train/loss", 5, 0.5)]
    assert sorted(map(tuple, L.dedup_series(L.latest_file(scalars)).collect())) == [("eval_loss", 6, 8.0), ("train/loss", 2, 3.0), ("train/loss", 5, 0.5)]
    assert sorted(map(tuple, L.tag_inventory(merged).collect())) == [("eval_loss", 2, 6, 8.0), ("train/loss", 3, 5, 0.5)]
    assert L.pick_series(merged, L.PANEL_TAGS["eval_loss"]).count() == 2 and L.pick_series(merged, ("a", "b")).count() == 0
    assert L.pick_series(merged, ("train/loss", "eval_loss")).select("tag").distinct().collect()[0].tag == "train/loss"
    assert L.run_horizon(merged).first()[0] == 6 and L.run_horizon(merged.limit(0)).first()[0] == 0
    assert {(r.tag, r.best_step) for r in L.best_point(merged, "tag").collect()} == {("eval_loss", 6), ("train/loss", 5)}
    assert L.best_point(merged, greater_is_better=True).first().best_step == 1


def test_checkpoints_compare_as_numbers(spark):
    df = spark.createDataFrame([("x/checkpoint-9", 1), ("x/checkpoint-10", 2), ("x/other", 3)], "folder string, v int")
    assert [r.v for r in L.latest_checkpoint(df).collect()] == [2]


def test_history(spark):
    def entries(*rows):
        return spark.createDataFrame([r + (None,) * (6 - len(r)) for r in rows], LOG_ENTRY)

    prior = entries((1, None, 1.0), (2, None, 2.0), (None, 7, 7.0), (0, 3, 3.0))
    current = entries((2, None, 20.0), (2, None, None, 5.0), (3, None, None, 6.0, 1.0, 1.0), (4, None, 4.0, None, 0.5, 0.1))
    merged = L.merge_history(prior, current).orderBy("at_step").collect()
    assert [r.at_step for r in merged] == [1, 2, 2, 3, 4, 7]
    series = L.entry_series(L.merge_history(prior, current)).groupBy("tag").agg(F.sort_array(F.collect_list("step")).alias("s")).collect()
    assert {r.tag: r.s for r in series} == {"train_loss": [1, 2, 4, 7], "eval_loss": [2, 3], "grad_norm": [4], "learning_rate": [4]}
