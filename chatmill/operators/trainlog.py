"""Training logs: merging runs, picking series, smoothing."""

from __future__ import annotations

from math import log, log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.operators.staging import stage

# Tags of the panels (first one present wins), smoothing factors, cap of the exponent.
PANEL_TAGS = {
    "train_loss": ("train/loss",),
    "eval_loss": ("eval/loss", "eval_loss"),
    "learning_rate": ("train/learning_rate",),
    "grad_norm": ("train/grad_norm",),
}
ALPHA, GRAD_NORM_ALPHA = 0.1, 0.2
MAX_EXPONENT = 20


def latest_file(scalars: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of the file with the last name, per log directory if `by` names one."""
    if by:
        last = scalars.groupBy(*by).agg(F.max("file").alias("file"))
        return scalars.join(last, [*by, "file"], "left_semi")
    return scalars.filter(F.col("file") == scalars.agg(F.max("file").alias("f")).scalar())


def latest_checkpoint(entries: DataFrame, folder: str = "folder", by: str | None = None) -> DataFrame:
    """Rows of the folder `checkpoint-<N>` with the highest N (as a number), per `by` if given."""
    number = F.regexp_extract(folder, r"checkpoint-(\d+)", 1)
    named = entries.withColumn("checkpoint", F.when(number != "", number.cast("bigint"))).filter(F.col("checkpoint").isNotNull())
    if by is None:
        return named.filter(F.col("checkpoint") == named.agg(F.max("checkpoint").alias("c")).scalar())
    last = named.groupBy(by).agg(F.max("checkpoint").alias("checkpoint"))
    return named.join(last, [by, "checkpoint"], "left_semi")


def dedup_series(scalars: DataFrame, keys: tuple[str, ...] = ("tag",), order: tuple[str, ...] = ("file", "seq")) -> DataFrame:
    """One value per series and step: the one that comes last in file order."""
    return scalars.groupBy(*keys, "step").agg(F.max_by("value", F.struct(*order)).alias("value"))


def tag_inventory(series: DataFrame) -> DataFrame:
    """Per tag: number of points, last step and its value."""
    return series.groupBy("tag").agg(
        F.count(F.lit(1)).alias("points"), F.max("step").alias("last_step"), F.max_by("value", "step").alias("last_value")
    )


def pick_series(series: DataFrame, candidates: tuple[str, ...]) -> DataFrame:
    """Points of the first candidate tag that occurs in the data; none if no one does."""
    place = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("tag"))
    found = series.filter(F.col("tag").isin(*candidates)).withColumn("__place", place)
    first = found.agg(F.min("__place").alias("p")).scalar()
    return found.filter(F.col("__place") == first).drop("__place")


def run_horizon(series: DataFrame) -> DataFrame:
    """One row: the last step of the train and eval loss series, 0 without any."""
    tags = (*PANEL_TAGS["train_loss"], *PANEL_TAGS["eval_loss"])
    return series.filter(F.col("tag").isin(*tags)).agg(F.coalesce(F.max("step"), F.lit(0)).alias("max_step"))


def best_point(series: DataFrame, by: str | None = None, greater_is_better: bool = False) -> DataFrame:
    """Step and value of the best point; the earliest step among equals."""
    rank = F.struct(-F.col("value") if greater_is_better else F.col("value"), F.col("step"))
    best = F.min_by(F.struct("step", "value"), rank).alias("b")
    found = series.groupBy(by).agg(best) if by else series.agg(best)
    return found.select(*([by] if by else []), F.col("b.step").alias("best_step"), F.col("b.value").alias("best_value"))


def entry_step() -> Column:
    """Step of a log entry: `step` unless absent or 0, then `global_step`, then 0."""
    return F.coalesce(F.nullif(F.col("step"), F.lit(0).cast("bigint")), F.col("global_step"), F.lit(0).cast("bigint"))


def merge_history(prior: DataFrame, current: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Entries of an earlier run whose step the current run has not logged, and all current entries.

    `keys` separates runs that are merged side by side. Adds `at_step`, the step to sort by.
    """
    prior, current = (df.withColumn("at_step", entry_step()) for df in (prior, current))
    on = [*keys, "at_step"]
    kept = prior.join(current.select(*on).distinct(), on, "left_anti")
    return kept.unionByName(current, allowMissingColumns=True)


def entry_series(entries: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Long series (`tag`, `step`, `value`) of sparse log entries.

    Gradient norm and learning rate count only on entries that carry a training loss.
    """
    step = F.col("at_step") if "at_step" in entries.columns else entry_step()
    loss = F.col("loss")

    def point(tag: str, value: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), value.alias("value"))

    points = F.array(
        point("train_loss", loss),
        point("eval_loss", F.col("eval_loss")),
        point("grad_norm", F.when(loss.isNotNull(), F.col("grad_norm"))),
        point("learning_rate", F.when(loss.isNotNull(), F.col("learning_rate"))),
    )
    rows = entries.select(*keys, step.alias("step"), F.explode(points).alias("p")).filter(F.col("p.value").isNotNull())
    return rows.select(*keys, F.col("p.tag").alias("tag"), "step", F.col("p.value").alias("value"))


# Maps of neighbouring blocks that are composed in one array.
CHAINED = 256


def block_length(alpha: float) -> int:
    """Rows smoothed as one running sum: as many as leave the powers of 1 - alpha within 10^±100, 4096 at most."""
    return 1 if alpha == 1 else max(1, min(4096, int(100 * log(10) / -log1p(-alpha))))


def _chained(maps: Column) -> Column:
    """Of an array of maps x -> a x + b, in order: `before`, an array of the compositions of all earlier ones, and `all`, the composition of all."""
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    start = F.struct(F.array().cast("array<struct<a: double, b: double>>").alias("before"), pair(F.lit(1.0), F.lit(0.0)).alias("all"))

    def then(done: Column, m: Column) -> Column:
        after = pair(m["a"] * done["all"]["a"], m["a"] * done["all"]["b"] + m["b"])
        return F.struct(F.concat(done["before"], F.array(done["all"])).alias("before"), after.alias("all"))

    return F.aggregate(maps, start, then)


def ema(
    series: DataFrame,
    keys: tuple[str, ...] = ("tag",),
    alpha: float = ALPHA,
    name: str = "ema",
    order: tuple[str, ...] = ("step",),
) -> DataFrame:
    """Exponential smoothing along `order`: s0 = v0, then s = alpha * v + (1 - alpha) * s. A null value counts as NaN, and all after a NaN is NaN.

    A row turns the smoothed value x before it into a x + b, and so does a run of rows. Rows are range-partitioned by series and order and
    cut into blocks, in which b is a running sum. The blocks' maps are chained in two steps, first neighbouring ones of a partition and then these
    chains of a series, and give each block the value it begins with. So a series may be longer than one task should hold, and all is built-in aggregates.
    Null keys are a series as any other.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie in (0, 1]")
    rest, length = 1 - alpha, block_length(alpha)
    value = F.coalesce(F.col("value").cast("double"), F.lit(float("nan")))
    rows = series.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # A struct of the keys, which is equal where its nulls are, is the one key of all joins.
    rows = rows.withColumns({"__key": F.struct(*keys), "__at": F.monotonically_increasing_id()})
    rows = stage(rows.withColumns({"__part": F.shiftright("__at", 33), "__block": F.floor(F.col("__at").bitwiseAND((1 << 33) - 1) / length)}), "ema")
    along = Window.partitionBy("__key", "__part", "__block").orderBy("__at")
    place = F.row_number().over(along)
    power = lambda n: F.pow(F.lit(rest), n.cast("double"))
    sums = rows.withColumn("__n", place).withColumn("__b", F.sum(value * alpha / power(F.col("__n") - 1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    local = sums.withColumn("__b", F.col("__b") * power(F.col("__n") - 1))

    where = ["__key", "__part", "__block"]
    blocks = local.groupBy(*where).agg(F.max_by("__b", "__at").alias("b"), F.max("__n").alias("n"), F.min_by(value, "__at").alias("first"))
    blocks = blocks.withColumn("m", F.struct(power(F.col("n")).alias("a"), "b")).withColumn("chain", F.floor(F.col("__block") / CHAINED))
    chains = blocks.groupBy("__key", "__part", "chain").agg(F.sort_array(F.collect_list(F.struct("__block", "m", "first"))).alias("held"))
    chains = chains.withColumn("c", _chained(F.transform("held", lambda h: h["m"])))
    linked = chains.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("__part", "chain", "c", "held"))).alias("chains"))
    linked = linked.withColumn("l", _chained(F.transform("chains", lambda c: c["c"]["all"])))
    start = F.col("chains")[0]["held"][0]["first"]
    carry = linked.select("__key", start.alias("start"), F.posexplode("chains").alias("i", "chain"), "l").select("__key", "start", "chain", F.col("l.before")[F.col("i")].alias("ahead"))
    carry = carry.select("__key", "start", "ahead", "chain.__part", F.posexplode("chain.held").alias("j", "held"), F.col("chain.c.before").alias("before"))
    at_start = F.col("ahead.a") * F.col("start") + F.col("ahead.b")
    inner = F.col("before")[F.col("j")]
    carry = carry.select("__key", "__part", F.col("held.__block").alias("__block"), (inner["a"] * at_start + inner["b"]).alias("__carry"))
    joined = local.join(carry, where)
    return joined.select(*series.columns, (F.col("__b") + power(F.col("__n")) * F.col("__carry")).alias(name))


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(float(MAX_EXPONENT))))


def loss_panel(series: DataFrame, keys: tuple[str, ...] = ("tag",)) -> DataFrame:
    """Series with `ema`, and `perplexity` of the raw and `perplexity_ema` of the smoothed value."""
    smoothed = ema(series, keys)
    return smoothed.withColumns({"perplexity": perplexity(F.col("value")), "perplexity_ema": perplexity(F.col("ema"))})
