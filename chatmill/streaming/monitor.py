"""Keeping the panels of a training run current."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatmill.operators.staging import new_path
from chatmill.operators.trainlog import ALPHA, GRAD_NORM_ALPHA, ema, entry_series, entry_step, merge_history, perplexity
from chatmill.schemas import LOG_ENTRY
from chatmill.sources.files import names_in, remove
from chatmill.sources.snapshots import note_of, point
from chatmill.streaming.results import ONCE

REFRESH_STEPS = 50
SMOOTHED = {"train_loss": ALPHA, "grad_norm": GRAD_NORM_ALPHA}
TAGS = ("train_loss", "eval_loss", "grad_norm", "learning_rate")

POINTS = "tag string, step long, value double, ema double, final boolean, earlier boolean, at long"


def _panels(points: DataFrame) -> DataFrame:
    train = F.col("tag") == "train_loss"
    return points.select("tag", "step", "value", "ema", F.when(train, perplexity(F.col("value"))).alias("perplexity"), F.when(train, perplexity(F.col("ema"))).alias("perplexity_ema"))


def _smoothed(series: DataFrame) -> DataFrame:
    # An entry without a step of its own may repeat one; the value breaks the tie.
    order = ("step", "value")
    parts = [ema(series.filter(F.col("tag") == tag), alpha=alpha, order=order) for tag, alpha in SMOOTHED.items()]
    others = series.filter(~F.col("tag").isin(*SMOOTHED)).withColumn("ema", F.lit(None).cast("double"))
    return parts[0].unionByName(parts[1]).unionByName(others)


def panel_table(prior: DataFrame, current: DataFrame) -> DataFrame:
    """All points of the merged history with their smoothed values and, for the loss, perplexities."""
    series = entry_series(merge_history(prior, current))
    return _panels(_smoothed(series))


def _marks(entries: DataFrame, *more: Column | str) -> DataFrame:
    """(`tag`, `step`, `value`) of every entry, once for each tag, also where the entry has no value of it: its step is news to all series."""
    with_loss = F.col("loss").isNotNull()
    values = {"train_loss": F.col("loss"), "eval_loss": F.col("eval_loss"), "grad_norm": F.when(with_loss, F.col("grad_norm")), "learning_rate": F.when(with_loss, F.col("learning_rate"))}
    points = F.array(*[F.struct(F.lit(t).alias("tag"), v.cast("double").alias("value")) for t, v in values.items()])
    return entries.select(entry_step().alias("step"), F.explode(points).alias("p"), *more).select("p.tag", "step", "p.value", *more)


class TrainingMonitor:
    """Refreshes the panels whenever the run is `every` steps past the last refresh, and at its end.

    A batch goes on from what the batch before it left, so it costs what came with it and the earlier run's points that are not passed yet, however long the
    run is; a series is smoothed by many tasks, however much comes in one batch. All of it is in `folder`: the points of each micro-batch (`points/batch=<n>`,
    so that a repeated batch replaces itself), the smoothed values after it among them, and the refreshes, notes that say up to which batch the panels count;
    readers of `panels()` find a whole table at any time.

    Entries come in order of their steps, as a run logs them; in a batch any order will do. One behind a step that is past is no error: from then
    on readers smooth all points anew.
    """

    def __init__(self, folder: str, prior: DataFrame, every: int = REFRESH_STEPS):
        self.folder, self.prior, self.every = folder.rstrip("/"), prior, every
        self.spark = prior.sparkSession

    def _note(self) -> dict:
        note = note_of(self.spark, f"{self.folder}/refreshes")
        return json.loads(note) if note else {"step": -1, "batch": -1, "late": False}

    def _points(self) -> DataFrame:
        return self.spark.read.schema(f"{POINTS}, batch int").parquet(f"{self.folder}/points")

    def panels(self) -> DataFrame:
        """The panels as of the last refresh: what was final by then, and what was not as it stood then."""
        note = self._note()
        if note["batch"] < 0:
            return panel_table(self.prior, self.spark.createDataFrame([], LOG_ENTRY))
        counts = (F.col("final") & (F.col("batch") <= note["batch"])) | (~F.col("final") & (F.col("batch") == note["batch"]))
        points = self._points().filter(counts & F.col("step").isNotNull())
        if note["late"]:
            logged = points.filter(~F.col("earlier"))
            kept = points.filter("earlier").join(logged.select("tag", "step").distinct(), ["tag", "step"], "left_anti")
            points = _smoothed(kept.unionByName(logged.filter(F.col("value").isNotNull()), allowMissingColumns=True).select("tag", "step", "value"))
        return _panels(points)

    def refresh(self, step: int, batch: int, late: bool) -> None:
        point(self.spark, f"{self.folder}/refreshes", json.dumps({"step": step, "batch": batch, "late": late}))

    def _reached(self, batch: int) -> tuple[int | None, bool]:
        """The last step of a batch, and whether an entry has come late."""
        at = self._points().filter((F.col("batch") == batch) & F.col("at").isNotNull()).agg(F.max("at").alias("high"), F.min("at").alias("low")).first()
        late = at["low"] is not None and at["low"] < 0
        return (-1 - at["low"] if late else at["high"]), late

    def _batches(self) -> list[int]:
        names = names_in(self.spark, f"{self.folder}/points")
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def _batch(self, batch: int) -> DataFrame:
        return self.spark.read.schema(POINTS).parquet(f"{self.folder}/points/batch={batch}")

    def _state(self, batch: int) -> tuple[DataFrame, int | None, bool, dict[str, float]]:
        """What the batches before this one left: points that may still change, the last step, whether an entry came late, and the smoothed values."""
        before = [b for b in self._batches() if b < batch]
        if not before:
            waiting = entry_series(self.prior).select("tag", "step", F.col("value").cast("double").alias("value"), F.lit(True).alias("earlier"))
            return waiting, None, False, {}
        left = self._batch(max(before))
        ends = left.filter(F.col("step").isNull()).collect()
        at = ends[0]["at"]
        held = left.filter(F.col("step").isNotNull() & ~F.col("final")).select("tag", "step", "value", "earlier")
        return held, -1 - at if at < 0 else at, at < 0, {r["tag"]: r["ema"] for r in ends if r["ema"] is not None}

    def on_entries(self, entries: DataFrame, batch_id: int) -> None:
        """Smooth a batch's points, going on from the smoothed values of the batch before.

        A point is final once a later step is known, since entries of one step may come in several batches. Points of the earlier run beyond the current
        run's step wait: each becomes final when the run has passed its step without an entry there, and is dropped when it has one. All are one chain in
        the order of their steps, begun by the smoothed value before it; those that are not final come last.
        """
        path = new_path(self.spark, "entries")
        entries.write.parquet(path)
        marks = _marks(self.spark.read.schema(entries.schema).parquet(path))
        reach = marks.agg(F.max("step").alias("high"), F.min("step").alias("low")).first()
        if reach["high"] is None:
            remove(self.spark, path)
            return
        held, at, late, smooth = self._state(batch_id)
        came_late = at is not None and reach["low"] < at
        late = late or came_late
        last = reach["high"] if at is None else max(reach["high"], at)
        fresh = marks.filter(F.col("step") >= at) if came_late else marks
        waiting = held.filter("earlier")
        passed = waiting.filter(F.col("step") < last).join(fresh.select("step").distinct(), "step", "left_anti")
        logged = fresh.filter(F.col("value").isNotNull()).withColumn("earlier", F.lit(False))
        begun = self.spark.createDataFrame([(tag, None, value, False) for tag, value in smooth.items()], "tag string, step long, value double, earlier boolean")
        series = reduce(DataFrame.unionByName, [begun, logged, held.filter(~F.col("earlier")), passed, waiting.filter(F.col("step") > last)])
        points = _smoothed(series).filter(F.col("step").isNotNull()).withColumn("final", F.col("step") < last)
        if came_late:
            points = points.unionByName(marks.filter(F.col("step") < at).withColumns({"ema": F.lit(None).cast("double"), "final": F.lit(True), "earlier": F.lit(False)}))
        columns = ["tag", "step", "value", "ema", "final", "earlier"]
        points.select(*columns, F.lit(None).cast("long").alias("at")).write.mode("overwrite").parquet(f"{self.folder}/points/batch={batch_id}")
        remove(self.spark, path)

        # Of equal points the later one's smoothed value is nearer to the value.
        along = F.struct("step", "value", -F.abs(F.col("ema") - F.col("value")))
        smooth |= {r["tag"]: r["ema"] for r in self._batch(batch_id).filter(F.col("final") & F.col("ema").isNotNull()).groupBy("tag").agg(F.max_by("ema", along).alias("ema")).collect()}
        # How far the run is; as a negative number once an entry has come behind a step that was final already.
        ends = [(tag, None, None, smooth.get(tag), False, False, -1 - last if late else last) for tag in TAGS]
        self.spark.createDataFrame(ends, POINTS).coalesce(1).write.mode("append").parquet(f"{self.folder}/points/batch={batch_id}")
        note = self._note()
        if last - note["step"] >= self.every:
            self.refresh(last, batch_id, late or note["late"])

    def start(self, entries: DataFrame, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery | None:
        """Follow a stream of log entries, with a `trigger` as results.ONCE has it; None (no monitor) if `every` is not positive."""
        if self.every <= 0:
            return None
        return entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.on_entries).trigger(**trigger).start()

    def finish(self) -> None:
        """The refresh at the end of training."""
        batches = self._batches()
        if batches:
            step, late = self._reached(max(batches))
            note = self._note()
            self.refresh(max(step or 0, note["step"]), max(batches), late or note["late"])
