"""Near-duplicate texts by min-max hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.components import components
from chatmill.llm.shingles import WordNumbers, mixed, shingle_set, words_of
from chatmill.llm.worker import kept
from chatmill.operators.staging import stage

# Bands and values in each. A band takes the smallest and the largest value of the same permutations, so the 24 * 5 values
# come from 60 permutations. Texts that share 85 % of their shingles miss all bands with a chance of (1 - 0.85 ** 5) ** 24 = 7.7e-7,
# those that share 80 % with (1 - 0.8 ** 5) ** 24 = 7.3e-5.
BANDS, ROWS = 24, 5
# Bands whose buckets are compared whole; of the others only buckets that still hold several components are.
FIRST_BANDS = 4
# Members, and bytes of their sets, that are compared with as many others in one task.
BLOCK, BLOCK_BYTES = 768, 6 << 20
# Shingles counted at a time in a block.
COLUMNS = 4096


def _numbers() -> WordNumbers:
    return kept("shingles", "words", WordNumbers)



def _permutations() -> tuple[np.ndarray, np.ndarray]:
    n = BANDS * ROWS // 2
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


_FACTORS, _SHIFTS = _permutations()


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: a hash of its min and max values."""
    low, high = np.empty(len(_FACTORS), np.uint64), np.empty(len(_FACTORS), np.uint64)
    for i, (a, b) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
        hashed = shingles * a + b  # odd factor: a permutation of all 64-bit numbers
        low[i], high[i] = hashed.min(), hashed.max()
    # A permutation's smallest and largest value go to different bands: at opposite ends they say different things of a set.
    values = np.concatenate([low, high]).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
    return keys


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, sid, bands, mark): a 64-bit print of the whole set, and the band keys, both null for a text without words; the md5 of the text."""
    ship(docs.sparkSession)
    kind = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    made = pa.struct([("n_shingles", pa.int64()), ("sid", pa.int64()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf(kind)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for t in texts:
                s = shingle_set(_numbers().of(words_of(t.as_py())))
                out.append({"n_shingles": len(s), "sid": _print(s), "bands": band_keys(s).view(np.int64)} if len(s) else {"n_shingles": 0, "sid": None, "bands": None})
            yield pa.array(out, made)

    return docs.select(F.col(key).alias("key"), sign(F.col(text)).alias("s"), F.md5(text).alias("mark")).select("key", "s.*", "mark")


def _print(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _contents(texts: DataFrame) -> DataFrame:
    """(sid, shingles): the set of each text, sorted and packed as 64-bit numbers; one row per set."""
    kind = T.StructType([T.StructField("sid", T.LongType()), T.StructField("shingles", T.BinaryType())])
    made = pa.struct([("sid", pa.int64()), ("shingles", pa.binary())])

    @F.arrow_udf(kind)
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            sets = [shingle_set(_numbers().of(words_of(t.as_py()))) for t in column]
            yield pa.array([{"sid": _print(s), "shingles": s.tobytes()} for s in sets], made)

    return texts.select(pack("text").alias("s")).select("s.*").dropDuplicates(["sid"])


def linked_members(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, parts: np.ndarray | None, least: int) -> np.ndarray:
    """Boolean matrix: which of the sets `left` are linked with which of the sets `right` (places in `sets`).

    Members of one component (equal `parts`) need no link and get none.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    common = np.bincount(at, minlength=len(values)) > 1
    column = np.cumsum(common) - 1
    use = common[at]
    owner, column = owner[use], column[at[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(left), len(right)), np.float32)
    row_of, col_of = np.full(len(sets), -1), np.full(len(sets), -1)
    row_of[left], col_of[right] = np.arange(len(left)), np.arange(len(right))
    for low in range(0, int(common.sum()), COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        a, b = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        o, c = owner[i:j], column[i:j] - low
        in_left, in_right = row_of[o] >= 0, col_of[o] >= 0
        a[row_of[o[in_left]], c[in_left]] = 1
        b[col_of[o[in_right]], c[in_right]] = 1
        both += a @ b.T  # sums of up to 4096 ones: exact
    either = sizes[left][:, None] + sizes[right][None, :] - both.astype(np.int64)
    linked = 100 * both.astype(np.int64) >= least * either
    linked &= left[:, None] != right[None, :]
    if parts is not None:
        linked &= parts[left][:, None] != parts[right][None, :]
    return linked


def forest(n: int, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the matrix connects: at most one for each of the n members."""
    out, row_of, col_of = [], np.full(n, -1), np.full(n, -1)
    row_of[left], col_of[right] = np.arange(len(left)), np.arange(len(right))
    new = np.ones(n, bool)
    for root in left[linked.any(axis=1)]:
        if not new[root]:
            continue
        new[root] = False
        front = np.array([root])
        while len(front):
            rows, cols = row_of[front], col_of[front]
            near = np.zeros(n, bool)
            near[right[linked[rows[rows >= 0]].any(axis=0)]] = True
            near[left[linked[:, cols[cols >= 0]].any(axis=1)]] = True
            front = np.flatnonzero(near & new)
            new[front] = False
            out += [(int(root), int(x)) for x in front]
    return out


def _compare(rows: DataFrame, least: int) -> DataFrame:
    """(a, b): links that connect the members of each group of (bucket, i, j), found in the task that holds the group.

    `rows` has bucket, i, j, side, sid, part, shingles. Groups with i < j compare side i with side j, the others all.
    """

    def one(group: pa.Table) -> list[tuple[int, int]]:
        sids, sides = group["sid"].to_numpy(), group["side"].to_numpy()
        parts = group["part"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["shingles"]]
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        every = np.arange(len(sids))
        left, right = (every, every) if i == j else (np.flatnonzero(sides == i), np.flatnonzero(sides == j))
        if len(sids) < 2 or not len(left) or not len(right):
            return []
        return [(int(sids[a]), int(sids[b])) for a, b in forest(len(sids), left, right, linked_members(sets, left, right, parts, least))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "i", "j"]):
            if links := one(group):
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    placed = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return placed.mapInArrow(run, "a long, b long")


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal long keys, from batches in which equal keys follow each other; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            this = tuple(values[:, low])
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(members: DataFrame, stats: DataFrame) -> DataFrame:
    """(bucket, i, j, side, sid, part): the members of each bucket in as many blocks as it needs, a row for each pair of blocks."""
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") * 8 / BLOCK_BYTES)).cast("long")
    rows = members.join(stats.select("bucket", blocks.alias("blocks")), "bucket")
    side = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    rows = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "sid", "part")


def _stats(members: DataFrame) -> DataFrame:
    return members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"), F.min("part").alias("p0"), F.max("part").alias("p1")).filter("m > 1 and p0 <> p1")


def _linked_sets(docs: DataFrame, key: str, text: str, least: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and for each different set (sid, first, group): its smallest key and its component."""
    signed = stage(signatures(docs, key, text), "signatures")
    usable = signed.filter("key is not null and sid is not null")
    sets = stage(usable.groupBy("sid").agg(F.min("key").alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "sets")
    members = sets.select("sid", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("bucket")
    members = stage(members.join(shared, "bucket").select("bucket", "band", "sid", "n"), "members")
    wanted = sets.join(members.select("sid").distinct(), "sid", "left_semi").select(F.col("first").alias("wanted"))
    texts = docs.select(F.col(key).alias("wanted"), F.col(text).alias("text")).join(wanted, "wanted", "left_semi")
    contents = stage(_contents(texts), "contents")

    alone = members.filter(F.col("band") < FIRST_BANDS).withColumn("part", F.col("sid"))
    rows = _in_blocks(alone.select("bucket", "sid", "part"), _stats(alone)).join(contents, "sid")
    links = stage(_compare(rows, least), "first-links")
    tree = components(links).withColumnRenamed("id", "sid")
    rest = members.filter(F.col("band") >= FIRST_BANDS).join(tree, "sid", "left").withColumn("part", F.coalesce("component", "sid"))
    rest = stage(rest.select("bucket", "sid", "n", "part"), "rest")
    rows = _in_blocks(rest.select("bucket", "sid", "part"), _stats(rest)).join(contents, "sid")
    links = links.unionByName(_compare(rows, least))
    tree = components(links).withColumnRenamed("id", "sid")
    return signed, sets.select("sid", "first").join(tree, "sid", "left").select("sid", "first", F.coalesce("component", "sid").alias("group"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 85) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of `docs`.

    Texts are linked if the sets of their distinct 5-word shingles (A-Z as a-z; fewer words: the whole sequence as one)
    share `least` percent of their union. `component_id` is the smallest key reachable by links, itself included, and `kept`
    says that it is the row's own. Null, empty and wordless texts have no shingles and no links. Rows of equal key are
    texts of their own. A null key takes no part: its component is null and it is kept.

    Equal sets are one member (by a 64-bit print of the whole set). Members that share a band's bucket are compared on their
    full sets, in blocks of bounded size, inside the task that holds two blocks: it passes on at most one link for each
    member, enough to connect them, and never a list of pairs. After the first bands most buckets lie within one component
    and are done; of the other bands only buckets across components are compared, and there only across. Tables between
    the steps are written to the shared folder.
    """
    signed, named = _linked_sets(docs, key, text, least)
    least_key = named.groupBy("group").agg(F.min("first").alias("component_id"))
    found = named.join(least_key, "group").select("sid", "component_id")
    # Copies of one text are one row in `found` and may be very many in `signed`: both sides stay splittable.
    out = signed.select("key", "n_shingles", "sid").join(found, "sid", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 80) -> DataFrame:
    """`docs` with one row of each group: of the rows with its smallest key one text (the least by shingle print, then by md5), once.

    Rows of equal key are texts of their own: of two that are no near copies both stay. Rows with a null key, and rows without words, all stay.
    """
    signed, named = _linked_sets(docs, key, text, least)
    first = named.groupBy("group").agg(F.min(F.struct("first", "sid")).alias("one")).select("one.*")
    rows = signed.select("key", "sid", "mark").join(first.withColumnRenamed("sid", "of"), (F.col("sid") == F.col("of")) & (F.col("key") == F.col("first")))
    kept = rows.groupBy(F.col("sid")).agg(F.min(F.struct("key", "mark")).alias("one")).select(F.col("one.key").alias("__kept"), F.col("one.mark").alias("__as"))
    marked = docs.withColumn("__mark", F.md5(text))
    # Both are dealt by key and text, so that repeated rows meet without another shuffle.
    once = marked.join(kept, (F.col(key) == F.col("__kept")) & (F.col("__mark") == F.col("__as")), "left_semi").dropDuplicates([key, "__mark"]).drop("__mark")
    wordless = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return once.unionByName(docs.filter(F.col(key).isNull() | wordless))
