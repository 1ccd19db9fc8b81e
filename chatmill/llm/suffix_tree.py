"""A language model: a probabilistic suffix tree over bytes of words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.shingles import WordNumbers, words_of
from chatmill.llm.worker import kept
from chatmill.operators.staging import new_path, stage
from chatmill.sources.files import file_system, mounted_path

# Symbols: the bytes of lower-cased words (none of which is a white-space byte or A-Z), a gap between words, the end, and
# what stands before a text.
GAP, END, START = 0x20, 0x0A, 0x0D
# Bytes of the longest context. A context and the byte after it fit into one 64-bit number.
DEPTH = 6
# A context is kept if it occurs so often, whatever the size of the corpus: more text gives more contexts, and what a small corpus teaches a large one does too.
LEAST_COUNT = 400
# Words of this share at least have their counts broadcast: there are at most 10^6 of them.
WORD_SHARE = 1e-6
# ... and if its next bytes differ from those after its own suffix by so much: the divergence in nats, times its count.
LEAST_GAIN = 12.0
# The least that the shorter context weighs in a distribution, in counts.
PRIOR = 2.0
# Numbers that wait to be merged into the counts, distinct counts that a task holds before it passes them on, bytes of text
# scored at a time, and lanes that they are read in.
WAITING, HELD, SCORED, LANES = 1_000_000, 1_000_000, 1_000_000, 2048
# Contexts whose rows are made together, texts scored together.
BUILT, TEXTS = 20_000, 1000

_END_NUMBER = xxhash.xxh64_intdigest(b"\n")


def _numbers() -> WordNumbers:
    return kept("suffix_tree", "words", WordNumbers)


def symbols(words: list[bytes]) -> bytes:
    """A text as symbols: DEPTH times START, the words with gaps between, END."""
    return bytes([START]) * DEPTH + b" ".join(words) + b"\n"


def windows(data: np.ndarray) -> np.ndarray:
    """For each place from DEPTH on: the DEPTH bytes before it and its own, as one number, the own byte last."""
    out = np.zeros(len(data) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        out = (out << np.uint64(8)) | data[k : len(data) - DEPTH + k]
    return out


class _Counts:
    """Counts of 64-bit numbers that are merged as they come."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.size += len(values)
        if self.size > WAITING:
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            keys, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            every, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
            self.n = np.bincount(at, weights=np.concatenate([self.n, n]), minlength=len(every)).astype(np.int64)
            self.keys, self.waiting, self.size = every, [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        out = self.keys, self.n
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return out


def count_corpus(texts: DataFrame) -> DataFrame:
    """(kind, number, n): how often each word (kind 0, the end included) and each window of bytes (kind 1) occurs in the column `text`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = _Counts(), _Counts()

        def rows(kind: int, counts: _Counts) -> pa.RecordBatch:
            keys, n = counts.take()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["kind", "number", "n"])

        for batch in batches:
            for text in batch["text"]:
                found = words_of(text.as_py())
                words.add(np.append(_numbers().of(found), np.uint64(_END_NUMBER)))
                grams.add(windows(np.frombuffer(symbols(found), np.uint8)))
            words.merge()
            grams.merge()
            if len(words.keys) > HELD:
                yield rows(0, words)
            if len(grams.keys) > HELD:
                yield rows(1, grams)
        yield rows(0, words)
        yield rows(1, grams)

    counted = texts.select("text").mapInArrow(count, "kind int, number long, n long")
    return counted.groupBy("kind", "number").agg(F.sum("n").alias("n"))


@dataclass
class Kept:
    """Kept contexts by (length, number), with the counts of the symbols after each one side by side: those of context i lie at offsets[i] to offsets[i + 1].
    With a context all that it holds, its beginnings and its suffixes, are kept, and the empty one, which comes first."""

    k: np.ndarray
    context: np.ndarray
    offsets: np.ndarray
    symbols: np.ndarray
    n: np.ndarray

    @staticmethod
    def of(counts: dict[bytes, dict[int, int]]) -> Kept:
        counts = {b"": counts.get(b"", {})} | counts
        contexts = sorted(counts, key=lambda c: (len(c), c))
        after = [sorted(counts[c].items()) for c in contexts]
        flat = np.array([x for xs in after for x in xs], np.int64).reshape(-1, 2)
        numbers = [int.from_bytes(c, "big") for c in contexts]
        return Kept(np.array([len(c) for c in contexts]), np.array(numbers, np.int64), np.cumsum([0, *map(len, after)]), flat[:, 0], flat[:, 1])

    def alphabet(self) -> np.ndarray:
        """A number for each of the 256 bytes: symbols that occur in order, all others share the last number."""
        found = np.unique(np.concatenate([self.symbols, [GAP, END, START]]))
        codes = np.full(256, len(found), np.int32)
        codes[found] = np.arange(len(found))
        return codes

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some contexts at a time, in order, the next state and the log10 probability of every symbol.

        A level, the contexts of one length, needs the level before it only: where a context itself goes no further its suffix may, and what a
        context has not seen is weighed by its suffix.
        """
        codes = self.alphabet()
        width = int(codes.max()) + 1
        starts = np.searchsorted(self.k, np.arange(DEPTH + 3))
        moves, chances = np.zeros((0, width), np.int32), np.zeros((0, width), np.float32)
        for length in range(int(self.k[-1]) + 1):
            low, high, end = starts[length], starts[length + 1], starts[length + 2]
            numbers, longer = self.context[low:high], self.context[high:end]
            if length:
                above = np.searchsorted(self.context[starts[length - 1] : low], numbers & ((1 << (8 * (length - 1))) - 1))
                moves, chances = moves[above], chances[above]
            else:
                moves, chances = np.zeros((1, width), np.int32), np.full((1, width), 1 / 256, np.float32)  # below the empty context, all bytes are alike
            moves[np.searchsorted(numbers, longer >> 8), codes[longer & 255]] = np.arange(high, end)
            for at in range(low, high, BUILT):
                to = min(at + BUILT, high)
                first, last = self.offsets[at], self.offsets[to]
                n = np.zeros((to - at, width))
                n[np.repeat(np.arange(to - at), np.diff(self.offsets[at : to + 1])), codes[self.symbols[first:last]]] = self.n[first:last]
                # The shorter context weighs as much as there are different symbols, at least PRIOR.
                prior = np.maximum(PRIOR, (n > 0).sum(axis=1, keepdims=True))
                chances[at - low : to - low] = (n + prior * chances[at - low : to - low]) / (n.sum(axis=1, keepdims=True) + prior)
                yield moves[at - low : to - low], np.log10(chances[at - low : to - low])


@dataclass
class SuffixTree:
    """States are kept contexts, the empty one first; for each the next state and the log10 probability of every symbol, by the symbol's code."""

    codes: np.ndarray
    moves: np.ndarray
    scores: np.ndarray

    @staticmethod
    def build(kept: Kept) -> SuffixTree:
        moves, scores = zip(*((m.copy(), s) for m, s in kept.rows()), strict=True)
        return SuffixTree(kept.alphabet(), np.concatenate(moves), np.concatenate(scores))

    @staticmethod
    def write(kept: Kept, path: str) -> tuple[int, int]:
        """Write moves and scores to `<path>.moves` and `<path>.scores`, level by level; returns their shape."""
        system, inside = file_system(path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{inside}.moves") as one, system.open_output_stream(f"{inside}.scores") as two:
            for moves, scores in kept.rows():
                one.write(np.ascontiguousarray(moves).tobytes())
                two.write(np.ascontiguousarray(scores).tobytes())
        return len(kept.k), moves.shape[1]

    @staticmethod
    def mapped(codes: np.ndarray, path: str, shape: tuple[int, int]) -> SuffixTree:
        """The tree of two local files, which stay on disk: what is used of them is in the machine's file cache, once for all workers."""
        return SuffixTree(codes, np.memmap(f"{path}.moves", np.int32, "r", shape=shape), np.memmap(f"{path}.scores", np.float32, "r", shape=shape))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text of symbols (see `symbols`), START not counted.

        All texts are one string that is cut into lanes of equal length, read side by side. A lane begins DEPTH symbols early:
        by then its state no longer hangs on where it began.
        """
        lengths = np.array([len(t) for t in texts])
        data = self.codes[np.frombuffer(b"".join(texts), np.uint8)]
        total = len(data)
        lanes = max(1, min(LANES, total // 64))
        step = -(-total // lanes)
        padded = np.concatenate([np.full(DEPTH, self.codes[START], np.int32), data, np.zeros(step * lanes - total, np.int32)])
        # Row k holds the k-th symbol of every lane; a lane's last DEPTH symbols are the next one's first.
        side_by_side = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (step + DEPTH, lanes), (padded.itemsize, step * padded.itemsize)))
        moves, scores, width = self.moves.reshape(-1), self.scores.reshape(-1), self.moves.shape[1]
        state = np.zeros(lanes, np.int64)  # a place in the table may be beyond 32 bits
        for k in range(DEPTH):
            state = moves[state * width + side_by_side[k]].astype(np.int64)
        out = np.empty((step, lanes), np.float32)
        for k in range(step):
            where = state * width + side_by_side[DEPTH + k]
            scores.take(where, out=out[k], mode="clip")  # all are in range: this spares a test and a copy
            state = moves.take(where, mode="clip").astype(np.int64)
        flat = out.T.ravel()[:total].astype(np.float64)
        ends = np.cumsum(lengths)
        sums = np.concatenate([[0.0], np.cumsum(flat)])
        starts = ends - lengths + DEPTH
        return sums[ends] - sums[starts]


def _level(k: int, number: Column) -> Column:
    """The last k bytes of a number, as a number."""
    return number.bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("long"))


def distributions(counts: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(k, context, c, next): for each context of k bytes that occurs `least_count` times or more its count and the counts of the symbols after it,
    from windows counted as (number, n), a row each. The empty context is there whatever its count."""
    levels = [F.struct(F.lit(k).alias("k"), _level(k + 1, F.col("number")).alias("gram")) for k in range(DEPTH + 1)]
    shorter = counts.select(F.explode(F.array(*levels[:-1])).alias("g"), "n").groupBy("g").agg(F.sum("n").alias("n"))
    grams = shorter.unionByName(counts.select(levels[-1].alias("g"), "n"))  # whole windows are counted already
    # Symbols as one list per context: a context has at most 256 of them.
    per = grams.groupBy(F.col("g.k").alias("k"), F.shiftrightunsigned("g.gram", 8).alias("context"))
    rows = per.agg(F.sum("n").alias("c"), F.collect_list(F.struct(F.col("g.gram").bitwiseAND(255).cast("int").alias("s"), "n")).alias("next"))
    return rows.filter((F.col("c") >= least_count) | (F.col("k") == 0))


def retained(contexts: DataFrame, least_gain: float = LEAST_GAIN) -> DataFrame:
    """Of the rows of `distributions` those that the tree keeps: contexts whose next symbols diverge from those after their suffix, all contexts that these
    hold (what begins or ends them), and the empty one.

    The divergence is the sum over symbols of n log((n / c) / (m / d)), of n of c places after the context and m of d after its suffix, in nats. A
    context that reaches over the end of a text is none.
    """
    suffix = F.when(F.col("k") > 0, F.expr("context & (shiftleft(1L, 8 * (k - 1)) - 1)"))
    longer = contexts.filter("k > 0").select("k", "context", "c", (F.col("k") - 1).alias("sk"), suffix.alias("sc"), F.explode("next").alias("x"))
    shorter = contexts.select(F.col("k").alias("sk"), F.col("context").alias("sc"), F.col("c").alias("d"), F.explode("next").alias("y"))
    # Each of the context's places is one of its suffix's, so every symbol after it is known there.
    met = longer.join(shorter, (longer["sk"] == shorter["sk"]) & (longer["sc"] == shorter["sc"]) & (longer["x.s"] == shorter["y.s"]))
    gain = F.sum(F.col("x.n") * F.log(F.col("x.n") * F.col("d") / (F.col("c") * F.col("y.n"))))
    ends = F.exists(F.sequence(F.lit(0), F.col("k") - 1), lambda i: F.call_function("shiftrightunsigned", F.col("context"), i * 8).bitwiseAND(255) == END)
    told = met.groupBy("k", "context").agg(gain.alias("gain")).filter((F.col("gain") >= least_gain) & ~ends)
    # A part of a context: the bytes from `low` bytes before its end on, `length` of them.
    parts = F.flatten(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda low: F.transform(F.sequence(F.lit(1), F.col("k") - low), lambda length: F.struct(length.alias("k"), low.alias("low")))))
    held = told.select("context", F.explode(parts).alias("p"))
    held = held.select(F.col("p.k").alias("k"), F.expr("shiftrightunsigned(context, 8 * p.low) & (shiftleft(1L, 8 * p.k) - 1)").alias("context")).distinct()
    root = contexts.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit(0).cast("long").alias("context"))
    return contexts.join(held.unionByName(root), ["k", "context"], "left_semi")


def fit_tree(counts: DataFrame, least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN) -> Kept:
    """The contexts of windows counted as (number, n). They are counted, tested and chosen in Spark; the driver gets those that are kept, as arrays."""
    rows = retained(stage(distributions(counts, least_count), "contexts"), least_gain)
    table = rows.select("k", "context", F.array_sort(F.transform("next", lambda x: F.struct(x["s"], x["n"]))).alias("next")).toArrow()
    # Put in order here: a sort in Spark would choose the contexts once more, to sample them.
    table = table.take(np.lexsort((table["context"].to_numpy(), table["k"].to_numpy())))
    after = table["next"].combine_chunks()
    k, context = table["k"].to_numpy(), table["context"].to_numpy()
    if not len(k):
        return Kept.of({})
    flat = after.flatten()
    offsets = np.concatenate([[0], np.cumsum(after.value_lengths().to_numpy(zero_copy_only=False))])
    return Kept(k, context, offsets, flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False))


def score_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """Score all texts by a model of those whose crc32 of the key, as text, does not leave `held` when divided by `folds`.

    Returns one row per row of `docs`: key, held_out, n_tokens (words, and one end), n_known (tokens that occur in the texts
    learned from), train_tokens, base_score and score. base_score is the log10 probability of the tokens by their smoothed
    counts: the sum of log10((c + 1) / (N + V + 1)) for a token of count c, with N tokens and V distinct ones learned from.
    score is the log10 probability that the suffix tree gives to the words' bytes, with gaps between and the end. Null,
    empty and wordless texts are one end. A null key counts as an empty text and has a row. Rows of equal key are texts of
    their own.

    All texts are counted, in their tasks before anything is shuffled. The tree grows with the corpus: it has every context that occurs LEAST_COUNT
    times and tells more than its suffix, 8 bytes on each executor's disk for each of its symbols. A word's count is broadcast if it has a share of WORD_SHARE of all tokens (so at most
    1 / WORD_SHARE words are); the others' are joined, and no word among those is in many texts.
    """
    spark = ship(docs.sparkSession)
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    texts = docs.select(F.col(key).alias("key"), (crc % folds == held).alias("held_out"), F.col(text).alias("text"))
    counts = stage(count_corpus(texts.filter(~F.col("held_out"))), "counts")
    words = counts.filter("kind = 0").select("number", "n")
    facts = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = facts["n"], facts["v"]
    chosen = fit_tree(counts.filter("kind = 1").select("number", "n"))
    # The tree grows with the corpus, so it is written to the shared folder, and a worker maps what it uses of it: there, if the folder is mounted, else from
    # the copy that Spark gives each executor.
    path = new_path(spark, "tree")
    shape, codes, name = SuffixTree.write(chosen, path), chosen.alphabet(), path.rpartition("/")[2]
    mounted = mounted_path(path)
    for kind in () if mounted else ("moves", "scores"):
        spark.sparkContext.addFile(f"{path}.{kind}")
    common = F.col("n") >= max(1.0, total * WORD_SHARE)
    head = words.filter(common).toPandas().sort_values("number")
    known = spark.sparkContext.broadcast((head["number"].to_numpy(np.int64), head["n"].to_numpy(np.int64)))
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType()))])
    made = pa.struct([("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.int64()))])

    @F.arrow_udf(kind)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held_here = kept("suffix_tree", "model", dict)
        if name not in held_here:
            held_here.clear()  # the model of an earlier run
            held_here[name] = SuffixTree.mapped(codes, mounted or SparkFiles.get(f"{name}.moves").removesuffix(".moves"), shape), known.value
        model, (numbers, times) = held_here[name]

        def tokens(found: list[bytes]) -> tuple[int, int, float, np.ndarray]:
            own = np.append(_numbers().of(found), np.uint64(_END_NUMBER)).view(np.int64)
            if not len(numbers):
                return len(own), 0, 0.0, own
            at = np.minimum(np.searchsorted(numbers, own), len(numbers) - 1)
            here = numbers[at] == own
            return len(own), int(here.sum()), float(np.log10(times[at[here]] + 1.0).sum()), own[~here]

        # In short parts, so that a worker holds the lists of few texts at a time.
        for column in (c.slice(at, TEXTS) for c in batches for at in range(0, len(c), TEXTS)):
            rows, scores, waiting, size = [], [], [], 0
            for t in column:
                found = words_of(t.as_py())
                rows.append(tokens(found))
                waiting.append(symbols(found))
                size += len(waiting[-1])
                if size > SCORED:
                    scores.append(model.score(waiting))
                    waiting, size = [], 0
            if waiting:
                scores.append(model.score(waiting))
            n, hits, base, rare = zip(*rows, strict=True) if rows else ((), (), (), ())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rare)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *rare])))
            parts = [pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(base, pa.float64()), pa.array(np.concatenate([np.zeros(0), *scores])), lists]
            yield pa.StructArray.from_arrays(parts, fields=list(made))

    rows = stage(texts.select(F.monotonically_increasing_id().alias("row"), "key", "held_out", measure("text").alias("m")).select("row", "key", "held_out", "m.*"), "scores")
    # Words without a count are in no text learned from: they add log10(1) = 0, and aren't known.
    rare = rows.select("row", F.explode("rare").alias("number")).join(words.filter(~common), "number").groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("sum"))
    out = rows.drop("rare").join(rare, "row", "left")
    base = F.col("base") + F.coalesce("sum", F.lit(0.0)) - F.col("n_tokens") * math.log10(total + distinct + 1)
    return out.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
