"""Repair of conversations: the cheapest edits that bring turns into the form system?, (user, assistant)+, or nothing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.operators.staging import stage

# What the edits cost.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5

# A longer conversation is cut into blocks of so many different rows, or so many characters of text.
BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 20

# What the form has seen so far: nothing, a system turn, a user turn last, an assistant turn last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NAMES = {"u": "user", "a": "assistant"}
LETTERS = "sua?"

# A row's code: place of its role's letter in LETTERS, 4 if its text is unfinished, 8 if it must go.
_UNFINISHED, _MUST_GO = 4, 8

Costs = tuple[float, float, float, float]  # by state; what the rest of a conversation costs
_FAR = float("inf")


def _closed(costs: list[float]) -> Costs:
    """The costs when turns may be inserted first."""
    user, assistant = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


END = _closed([0, _FAR, _FAR, 0])


def _level(costs: Costs) -> tuple[Costs, float]:
    low = min(costs)
    return (tuple(c - low for c in costs), low) if low < _FAR else (costs, 0)


def _edits(code: int, state: int, rest: Costs) -> dict[str, tuple[float, int, float]]:
    """By initial of the edit of a row: the edit's cost, the state after it, and the cost with the rest."""
    out = {"D": (DELETE, state)}
    if not code & _MUST_GO:
        extra, letter = UNFINISHED if code & _UNFINISHED else 0, LETTERS[code & 3]
        if (state, letter) in NEXT:
            out["K"] = extra, NEXT[state, letter]
        out["R"] = extra + REROLE, NEXT[state, WANTED[state]]
    return {edit: (cost, after, cost + rest[after]) for edit, (cost, after) in out.items()}


@lru_cache(maxsize=1 << 16)
def before(code: int, rest: Costs) -> tuple[Costs, float]:
    """Costs ahead of a row from those behind it, less their least, and that least. Levelled costs take few values, so they are remembered."""
    return _level(_closed([min(total for _, _, total in _edits(code, state, rest).values()) for state in range(4)]))


@lru_cache(maxsize=1 << 16)
def walked(code: int, state: int, rest: Costs) -> tuple[str, int, float]:
    """The edits up to and including that of a row, the state after it and their cost: of the edits on a cheapest way always
    the one whose initial comes first. An initial names one edit in every state, so this gives the least string."""
    here = _closed([min(total for _, _, total in _edits(code, s, rest).values()) for s in range(4)])
    done, spent = "", 0.0
    while True:
        ways = _edits(code, state, rest)
        after = NEXT[state, WANTED[state]]
        ways["I"] = INSERT, after, INSERT + here[after]
        edit = min(e for e, (_, _, total) in ways.items() if total == here[state])
        cost, state, _ = ways[edit]
        done, spent = done + edit, spent + cost
        if edit != "I":
            return done, state, spent


def closing(state: int) -> str:
    """The insertions that end a conversation in this state."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def repair(codes: bytes, rest: Costs = END, state: int = START) -> tuple[list[str], int, float]:
    """The edits of each row, the state behind the last one, and their cost; `rest` is what follows, levelled.

    Costs run backward, the edits forward. Going backward, the costs are stored at every ceil(sqrt(n))-th row only; going forward, those of the
    rows between two such marks are computed again from the later mark, so about 2 sqrt(n) vectors are held for n rows.
    """
    n = len(codes)
    gap = isqrt(max(n - 1, 0)) + 1
    marks, now = {}, rest
    for i in range(n - 1, -1, -1):
        if (i + 1) % gap == 0 or i == n - 1:
            marks[i + 1] = now
        now, _ = before(codes[i], now)
    out, spent = [], 0.0
    for low in range(0, n, gap):
        high = min(low + gap, n)
        behind = [marks[high]]
        for i in range(high - 1, low, -1):
            behind.append(before(codes[i], behind[-1])[0])
        for i in range(low, high):
            edits, state, cost = walked(codes[i], state, behind.pop())
            out.append(edits)
            spent += cost
    return out, state, spent


def crossing(codes: bytes) -> list[float]:
    """By state at the end and state at the start (16 numbers): the least cost of a block of rows; infinite where there is no way."""
    out: list[float] = []
    for end in range(4):
        now, total = tuple(0.0 if s == end else _FAR for s in range(4)), 0.0
        for code in reversed(codes):
            now, low = before(code, now)
            total += low
        out += [c + total for c in now]
    return out


_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_NUMBERS = ("rows", "blank", "duplicate", "truncated", "illegal", "n_turns", "cost")
_ARROW = {"turns": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), "extra": pa.list_(pa.int64()), "crossing": pa.list_(pa.float64()), "codes": pa.binary(), "whole": pa.bool_()}
_TEXTS = ("edits", "first", "last")


def _block_fields(key: T.DataType) -> list[T.StructField]:
    kinds = {"conversation": key, "block": T.LongType(), "whole": T.BooleanType(), "codes": T.BinaryType(), "extra": T.ArrayType(T.LongType()), "turns": _TURNS, "edits": T.StringType()}
    kinds |= {"first": T.StringType(), "last": T.StringType(), "first_turn": T.LongType(), "last_turn": T.LongType(), "crossing": T.ArrayType(T.DoubleType())}
    return [T.StructField(n, k) for n, k in (kinds | {n: T.LongType() for n in _NUMBERS}).items()]


def edited(turns: list[dict], edits: list[str]) -> list[dict]:
    """The turns that the edits leave, `edits` by turn, insertions before the turn's own edit or after it."""
    out, last = [], ""
    for turn, own in zip([*turns, {}], [*edits, ""] if len(edits) == len(turns) else edits, strict=True):
        for edit in own:
            if edit == "D":
                continue
            role = turn["role"] if edit == "K" else NAMES["a" if last == "u" else "u"]
            out.append({"role": role, "text": "" if edit == "I" else turn["text"]})
            last = role[:1]
    return out


def _finished(turns: list[dict], codes: bytes, extra: list[int], rest: Costs, state: int, ends: bool) -> dict:
    edits, after, cost = repair(codes, rest, state)
    last = closing(after) if ends else ""
    # The letter before the block decides what its first insertion or new role is.
    lead = [{"role": {START: "", SYSTEM: "s", USER: "u", ASSISTANT: "a"}[state], "text": ""}]
    return {
        "turns": edited(lead + turns, ["K", *edits, last])[1:],
        "edits": "".join(e + "D" * n for e, n in zip(edits, extra, strict=True)) + last,
        "cost": int(cost) + DELETE * sum(extra) + INSERT * len(last),
    }


class _Run:
    """Different rows of one conversation, in order, up to the size of a block."""

    def __init__(self, key):
        self.key, self.turns, self.codes, self.extra, self.chars = key, [], bytearray(), [], 0
        self.n = dict.fromkeys(_NUMBERS, 0)
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, copies: int, seen: bool, blank: bool, unfinished: bool) -> None:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "?"
        gone = blank or seen
        if self.codes and (LETTERS[self.codes[-1] & 3] + letter) not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.codes.append(LETTERS.index(letter) | _UNFINISHED * unfinished | _MUST_GO * gone)
        self.turns.append({"role": role, "text": text})
        self.extra.append(copies - 1)
        self.chars += len(text)
        self.n["rows"] += copies
        self.n["illegal"] += copies - 1
        self.n["blank"] += copies * blank
        self.n["duplicate"] += 0 if blank else copies - 1 + seen
        self.n["truncated"] += not gone and unfinished
        if turn is not None:
            self.n["n_turns"] += turn != self.last_turn
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn

    def full(self) -> bool:
        return len(self.codes) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def row(self, block: int, whole: bool) -> dict:
        codes = bytes(self.codes)
        out = {"conversation": self.key, "block": block, "whole": whole, "first": LETTERS[codes[0] & 3], "last": LETTERS[codes[-1] & 3], "first_turn": self.first_turn, "last_turn": self.last_turn, **self.n}
        if whole:
            return out | {"codes": None, "extra": None, "crossing": None} | _finished(self.turns, codes, self.extra, END, START, True)
        return out | {"codes": codes, "extra": self.extra, "crossing": crossing(codes), "turns": self.turns, "edits": None}


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(t["text"]) for t in row["turns"])
        if len(held) >= 2000 or chars >= BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(rows: Iterator[tuple], first: int) -> Iterator[dict]:
    """Blocks of rows that come in order. A conversation that other tasks cannot have rows of, and that fits into a block, is finished at once."""
    run, edge, at = None, True, first
    for key, *values in rows:
        if run is not None and (key != run.key or run.full()):
            ended = key != run.key
            yield run.row(at, ended and not edge)
            edge = not ended  # the next block of a conversation that goes on is no whole conversation either
            at, run = at + 1, None
        if run is None:
            run = _Run(key)
        run.add(*values)
    if run is not None:
        yield run.row(at, False)


def _blocks(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    said = df.select(F.col(conversation).alias("conversation"), F.col(turn).cast("long").alias("turn"), *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    # Equal rows stand side by side, and all but the first have to go: they travel as one row with their number.
    lines = stage(said.groupBy("conversation", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("mark", F.md5(F.concat_ws(":", "role", "text"))), "lines")
    same = lines.groupBy("conversation", F.length("role").alias("of"), "mark").agg(F.min(F.struct("turn")).alias("earliest"), F.count(F.lit(1)).alias("n"))
    again = stage(same.filter("n > 1").select(F.col("conversation").alias("c"), "of", F.col("mark").alias("m"), "earliest"), "repeated")
    joined = lines.join(again, F.col("conversation").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")) & (F.length("role") == F.col("of")), "left")
    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    faults = joined.select(
        "conversation", "turn", "role", "text", "copies",
        F.coalesce(F.struct("turn") > F.col("earliest"), F.lit(False)).alias("seen"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("unfinished"),
        "mark",
    )
    order = ["conversation", "turn", "mark", F.length("role")]
    placed = faults.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark")
    fields = _block_fields(lines.schema["conversation"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = (TaskContext.get().partitionId()) << 33
        kinds: list[pa.Field] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                if not kinds:
                    kinds.append(batch.schema.field("conversation"))
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        found = _cut(rows(), first)
        for head in found:
            schema = pa.schema([(f.name, kinds[0].type if f.name == "conversation" else _ARROW.get(f.name, pa.string() if f.name in _TEXTS else pa.int64())) for f in fields])
            yield from _batches((r for part in ([head], found) for r in part), schema)

    return placed.mapInArrow(cut, T.StructType(fields))


def repair_conversations(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Repaired conversations, in blocks: (conversation, block, whole, turns array<struct<role, text>>, edits, cost, and counts of faults).

    A conversation's rows are read by turn, nulls first, equal turns by the md5 of `role:text`; null roles and texts count as one space, a
    null conversation is one as well. A row is blank (nothing but white space), else a duplicate (role and text seen earlier), else truncated (the last
    character that is no white space is not one of `.!?`). Blank rows and duplicates are deleted. The edits are the cheapest ones under which the roles'
    initials read `(s?(ua)+)?`: K(eep) 0, R(erole) 1, D(elete) 2, I(nsert) an empty user or assistant turn 5, and 5 more for a truncated
    row that stays; of equally cheap ones those whose initials come first as ASCII. `edits` has an initial for every row and insertion.

    Blocks of a conversation are in the order of `block`; most have one. Repeated rows are duplicates; an empty table gives no rows; columns but the four
    named ones are not handed on.

    Rows are dealt to tasks by ranges of their order, so a conversation with a third of all rows is spread over many tasks. Each block
    is summed up by 16 costs (from state to state); a conversation's blocks are chained by these numbers, backward for the costs behind each block
    and forward for the state before it, and only then each block is edited on its own.
    """
    spark = ship(df.sparkSession)
    blocks = stage(_blocks(df, conversation, turn, role, text), "blocks")
    fields = blocks.schema.fields
    pieces = blocks.filter(~F.col("whole"))
    brief = pieces.select("conversation", "block", "codes", "crossing")

    def backward(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["block"].to_pylist(), table["crossing"].to_pylist(), strict=True), reverse=True)
        out, rest = [], END
        for block, ways in rows:
            out.append((block, list(rest)))
            rest, _ = _level(tuple(min(ways[4 * end + s] + rest[end] for end in range(4)) for s in range(4)))
        return pa.table([pa.array([b for b, _ in out], pa.int64()), pa.array([r for _, r in out], pa.list_(pa.float64()))], ["block", "rest"])

    rests = stage(brief.select("conversation", "block", "crossing").groupBy("conversation").applyInArrow(backward, "block long, rest array<double>"), "rests")

    @F.arrow_udf("array<int>")
    def ways(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for codes, rest in columns:
            yield pa.array([[repair(c, tuple(r), s)[1] for s in range(4)] for c, r in zip(codes.to_pylist(), rest.to_pylist(), strict=True)], pa.list_(pa.int32()))

    led = brief.join(rests, "block").select("conversation", "block", "rest", ways("codes", "rest").alias("ends"))

    def forward(table: pa.Table) -> pa.Table:
        state, out = START, []
        rows = sorted(zip(table["block"].to_pylist(), table["ends"].to_pylist(), table["rest"].to_pylist(), strict=True), key=lambda r: r[0])
        for block, ends, rest in rows:
            out.append((block, rest, state, block == rows[-1][0]))
            state = ends[state]
        kinds = (pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.bool_())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["block", "rest", "state", "final"])

    starts = led.groupBy("conversation").applyInArrow(forward, "block long, rest array<double>, state int, final boolean")

    made = T.StructType([T.StructField("turns", _TURNS), T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())])

    @F.arrow_udf(made)
    def finish(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        kind = pa.struct([("turns", _ARROW["turns"]), ("edits", pa.string()), ("cost", pa.int64())])
        for batch in columns:
            out = [_finished(turns, codes, extra, tuple(rest), state, final) for turns, codes, extra, rest, state, final in zip(*(c.to_pylist() for c in batch), strict=True)]
            yield pa.array(out, kind)

    done = pieces.join(starts.hint("merge"), "block").withColumn("made", finish("turns", "codes", "extra", "rest", "state", "final"))
    changed = [F.col(f"made.{f.name}").alias(f.name) if f.name in ("turns", "edits", "cost") else F.col(f.name) for f in fields]
    return blocks.filter("whole").unionByName(done.select(*changed)).drop("codes", "extra", "crossing").withColumnRenamed("conversation", conversation)


def digests(blocks: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps in its turns, counts of faults and of illegal neighbours, cost, edits (`audit`), and the SHA-256 of its
    repaired `role:text`, newline-joined.

    The blocks of a conversation in one block are summed up where they are. Those of others meet in order of the
    block; their edits are one value of the result, so they fit into a row. Their texts are read one block after the other and hashed on the way.
    """
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    one = blocks.filter("whole").select(conversation, *_sums(), F.col("edits").alias("audit"), F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    pieces = stage(blocks.filter("not whole").withColumn("lines", line).drop("turns"), "pieces")
    by_block = F.sort_array(F.collect_list(F.struct("block", "edits", "first", "last", "first_turn", "last_turn")))
    sums = pieces.groupBy(F.col(conversation).alias("c")).agg(
        *[F.sum(n).alias(n) for n in _NUMBERS], F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), by_block.alias("parts")
    )
    # Neighbouring blocks: a pair of roles more, a turn counted twice where both have it. Blocks of null turns come first.
    meet = F.zip_with(F.slice("parts", 1, F.size("parts") - 1), F.slice("parts", 2, F.size("parts")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    legal = lambda p: F.concat(p["a"]["last"], p["b"]["first"]).isin("su", "ua", "au")
    sums = (
        sums.withColumn("meet", meet)
        .withColumn("illegal", F.col("illegal") + F.size(F.filter("meet", lambda p: ~legal(p))))
        .withColumn("n_turns", F.col("n_turns") - F.size(F.filter("meet", lambda p: p["a"]["last_turn"] == p["b"]["first_turn"])))
        .withColumn("audit", F.array_join(F.transform("parts", lambda p: p["edits"]), ""))
    )
    key = blocks.schema[conversation].dataType

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for k, lines in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if digest is not None and k != now:
                    yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])], ["k", "repaired_sha256"])
                    digest = None
                fresh = digest is None
                now, digest = k, digest or hashlib.sha256()
                empty = True if fresh else empty
                for said in lines.as_py():
                    digest.update((said if empty else "\n" + said).encode("utf-8", "surrogatepass"))
                    empty = False
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()])], ["k", "repaired_sha256"])

    ordered = pieces.select(conversation, "block", "lines").repartition(conversation).sortWithinPartitions(conversation, "block")
    hashes = ordered.mapInArrow(hashed, T.StructType([T.StructField("k", key), T.StructField("repaired_sha256", T.StringType())]))
    many = sums.join(hashes, F.col("c").eqNullSafe(F.col("k"))).select(F.col("c").alias(conversation), *_sums(), "audit", "repaired_sha256")
    return one.unionByName(many)


def _sums() -> list:
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.coalesce(wide("last_turn") - wide("first_turn") + 1 - F.col("n_turns"), F.lit(0)).try_cast("long")
    return [gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost"]
