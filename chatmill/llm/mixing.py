"""Mixing sources to target weights: words in blocks, block counts drawn for each output shard, blocks taken by permuted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.llm.feistel import permute
from chatmill.operators.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
# Words in a block, and blocks in an output shard.
BLOCK_WORDS, SHARD_BLOCKS = 64, 16_384
# No word is taken more often than this.
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
# Slices of a source in which its texts are put in order: a source of any size is ordered by many tasks.
SLICES = 4096
# Up to so many sources their table (five numbers and a name each) is broadcast; more are joined by shuffle.
FEW_SOURCES = 20_000


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """From (source, source_size) the target of each source, with `nth`, its place in code-point order, nulls last.

    Sources share the sum of all sizes by weight (repeating in order). A target stops at `most` times the size, and what is
    over goes to the others by weight until none is above: with sources in the order of size for weight, those up to some
    place are full, and the rest share what these leave.
    """
    nth = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.withColumn("nth", F.row_number().over(nth) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "nth")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    others = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("share", left / others)
    open_ = F.col("share") * F.col("weight") < F.col("limit")
    rate = F.first(F.when(open_, F.col("share")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.coalesce(F.least(rate * F.col("weight"), F.col("limit")), F.col("limit"))
    return rows.withColumn("rate", rate).select("source", "source_size", "nth", target.cast("double").alias("target"))


def _with_sources(df: DataFrame, sources: DataFrame, few: bool, *columns: str) -> DataFrame:
    side = sources.select("nth", *columns)
    return df.join(F.broadcast(side) if few else side, "nth")


def _running(df: DataFrame, by: str | None, order: str, value: str) -> Column:
    window = (Window.partitionBy(by) if by else Window.partitionBy(F.lit(0))).orderBy(order)
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


class Mix:
    """A mix of the texts of all sources.

    `docs` needs one row per text, with the columns named `key`, `source` and `text`; rows with equal keys, or equal in all, are
    texts of their own. The texts of a source, in an order drawn by the seed, are a run of words that is cut into blocks of
    `block_words`. Every output shard draws the source of each of its slots by the weights of the targets, which makes its
    counts multinomial. Over all shards a source gets the blocks its target asks for: what the draws give beyond that, in
    the last shards, goes to the sources that are short. The k-th slot of a source takes block permutation(k mod blocks) of
    its round k div blocks, so that no block is taken again before all have been taken. Same rows and seed, same mix.

    Null texts have no words. Sources without words have target 0. Without any rows all tables are empty.
    """

    def __init__(self, docs: DataFrame, seed: int = 42, key: str = "doc_id", source: str = "source", text: str = "text", keep: bool = False,
                 block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, weights: tuple[int, ...] = WEIGHTS):
        self.seed, self.block_words, self.shard_blocks, self.columns = seed, block_words, shard_blocks, docs.columns
        whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep else []
        print_ = F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text))
        #: row, key, source, size, draw, and the row itself when kept
        self.rows = stage(
            docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), print_.alias("draw"), *whole),
            "mix-rows",
        )
        sizes = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(sizes, weights)
        blocks = F.ceil(F.col("source_size") / block_words).cast("long")
        quota = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * blocks)).otherwise(0).cast("long")
        targets = targets.withColumns({"blocks": blocks, "quota": quota})
        self.sources = stage(targets.withColumn("from", _running(targets, None, "nth", "quota")).coalesce(1), "mix-sources")
        facts = self.sources.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quota"), F.lit(0)).alias("slots")).first()
        self.few, self.slots = facts["n"] <= FEW_SOURCES, facts["slots"]

    def _numbered(self) -> DataFrame:
        side = self.sources.select(F.col("source").alias("__source"), "nth")
        return self.rows.join(F.broadcast(side) if self.few else side, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    def shard_counts(self) -> DataFrame:
        """(shard, nth, n, first): blocks of each source in each shard, and the source's slots in earlier shards."""
        spark, slots, size = self.rows.sparkSession, self.slots, self.shard_blocks
        # Each slot draws one of as many tickets as there are slots; a source holds as many as its quota.
        draws = spark.range(slots).select((F.col("id") / size).cast("long").alias("shard"), F.pmod(F.xxhash64(F.lit(self.seed), F.lit("draw"), "id"), F.lit(max(slots, 1))).alias("ticket"))
        tickets = self._spread(self.sources.select("nth", F.col("from").alias("low"), "quota"), "quota").select("nth", (F.col("low") + F.col("at")).alias("ticket"))
        drawn = draws.join(tickets.hint("merge"), "ticket").groupBy("shard", "nth").agg(F.count(F.lit(1)).alias("n"))
        drawn = _with_sources(stage(drawn, "mix-draws"), self.sources, self.few, "quota")
        kept = F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("seen")))
        drawn = drawn.withColumn("seen", _running(drawn, "nth", "shard", "n")).withColumn("kept", kept.cast("long"))
        freed = drawn.groupBy("shard").agg(F.sum(F.col("n") - F.col("kept")).alias("freed")).filter("freed > 0")
        freed = self._spread(freed.withColumn("low", _running(freed, None, "shard", "freed")), "freed").select("shard", (F.col("low") + F.col("at")).alias("place"))
        got = drawn.groupBy("nth").agg(F.sum("kept").alias("got"))
        short = self.sources.join(got, "nth", "left").select("nth", (F.col("quota") - F.coalesce(F.col("got"), F.lit(0))).alias("short")).filter("short > 0")
        short = self._spread(short.withColumn("low", _running(short, None, "nth", "short")), "short").select("nth", (F.col("low") + F.col("at")).alias("place"))
        more = freed.join(short.hint("merge"), "place").groupBy("shard", "nth").agg(F.count(F.lit(1)).alias("n"))
        counts = drawn.select("shard", "nth", F.col("kept").alias("n")).unionByName(more).groupBy("shard", "nth").agg(F.sum("n").alias("n"))
        return counts.withColumn("first", _running(counts, "nth", "shard", "n"))

    @staticmethod
    def _spread(df: DataFrame, count: str, chunk: int = 4096) -> DataFrame:
        """A row for each number `at` below the count, made in chunks that are dealt out, so that a large count is no large row."""
        last = (F.col(count) - 1) / chunk
        chunks = df.filter(F.col(count) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last).cast("long"))))
        # A given number of partitions: the few bytes of the chunks say nothing of the rows that they stand for.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = chunks.repartition(tasks, F.xxhash64(*[c for c, t in chunks.dtypes if t in ("bigint", "int")]))
        start = F.col("chunk") * chunk
        return chunks.withColumn("at", F.explode(F.sequence(start, F.least(start + chunk, F.col(count)) - 1))).drop("chunk")

    def placements(self) -> DataFrame:
        """(shard, nth, slot, round, block): the block that each slot of each shard takes."""
        slots = self._spread(_with_sources(self.shard_counts(), self.sources, self.few, "blocks"), "n").withColumn("k", F.col("first") + F.col("at"))
        turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
        block = permute(F.col("k") % F.col("blocks"), F.col("blocks"), F.concat_ws(":", F.lit(self.seed), "nth", turn))
        return slots.select("shard", "nth", F.col("at").alias("slot"), turn.alias("round"), block.alias("block"))

    def text_blocks(self) -> DataFrame:
        """(row, nth, start, block, words): the blocks that each text lies in, with its words in each; start is its first word's place."""
        part = F.pmod(F.col("draw"), F.lit(SLICES)).cast("int")
        rows = self._numbered().filter("size > 0").select("row", "nth", "size", "draw", "key", part.alias("part"))
        parts = rows.groupBy("nth", "part").agg(F.sum("size").alias("part_size"))
        parts = parts.select("nth", "part", _running(parts, "nth", "part", "part_size").alias("before"))
        inside = Window.partitionBy("nth", "part").orderBy("draw", F.col("key").cast("string"), "size", "row").rowsBetween(Window.unboundedPreceding, -1)
        placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(parts, ["nth", "part"])
        placed = placed.select("row", "nth", "size", (F.col("before") + F.col("inside")).alias("start"))
        n = self.block_words
        low, high = F.floor(F.col("start") / n).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / n).cast("long")
        spread = placed.withColumn("block", F.explode(F.sequence(low, high)))
        words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * n) - F.greatest(F.col("start"), F.col("block") * n)
        return spread.select("row", "nth", "start", "block", words.alias("words"))

    def words_taken(self) -> DataFrame:
        """(key, size, source_size, target, taken) for each row: its words, its source's words and target, and the words that the mix takes of it, repeats counted."""
        times = self.placements().groupBy("nth", "block").agg(F.count(F.lit(1)).alias("times"))
        taken = self.text_blocks().join(times.hint("merge"), ["nth", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        rows = _with_sources(self._numbered(), self.sources, self.few, "source_size", "target").select("row", "key", "size", "source_size", "target")
        return rows.join(taken, "row", "left").select("key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def texts(self, text: str = "text", length: str | None = "n_chars") -> DataFrame:
        """The mix as rows with the columns of `docs` (which must be kept): each round that takes blocks of a text gives one row.

        A text that a round takes whole is kept as it is; of another, the words taken are joined by single spaces, and
        `length`, if there is such a column, is set to the new number of characters. Texts without words are in no block.
        """
        places = self.placements().select("nth", "round", "block")
        pieces = self.text_blocks().join(places.hint("merge"), ["nth", "block"]).groupBy("row", "round").agg(F.sum("words").alias("words"), F.first("start").alias("start"), F.sort_array(F.collect_list("block")).alias("blocks"))
        rows = pieces.join(self.rows.select("row", "size", "doc"), "row")
        n, body = self.block_words, F.col(f"doc.`{text}`")
        words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
        cut = F.transform("blocks", lambda b: F.struct(F.greatest(b * n - F.col("start"), F.lit(0)).alias("low"), F.least((b + 1) * n - F.col("start"), F.col("size")).alias("high")))
        rows = rows.withColumns({"all": F.when(F.col("words") < F.col("size"), words), "cut": cut})
        slices = F.flatten(F.transform("cut", lambda c: F.slice("all", (c["low"] + 1).cast("int"), (c["high"] - c["low"]).cast("int"))))
        rows = rows.withColumn("mixed", F.when(F.col("words") >= F.col("size"), body).otherwise(F.array_join(slices, " ")))
        changed = {text: F.col("mixed")} | ({length: F.when(F.col("words") >= F.col("size"), F.col(f"doc.`{length}`")).otherwise(F.length("mixed").cast("long"))} if length in self.columns else {})
        return rows.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in self.columns])
