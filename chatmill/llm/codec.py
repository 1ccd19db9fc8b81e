"""Byte-level byte-pair encoding by a finite-state transducer, and streaming decoding."""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship
from chatmill.llm.byte_level import SPLIT, Pieces, read_ranks
from chatmill.llm.worker import kept

# What a Python worker remembers: bytes of pieces with their ids (twice that, as the last table stays beside the growing one; the longest piece,
# in characters), transitions of states, and moves of ways. They bound its memory only: what isn't remembered is made again.
REMEMBERED, LONGEST, TRANSITIONS, MOVES = 60_000_000, 48, 400_000, 600_000
# A way is given up early where at most so many tokens could still end it and none can follow.
FEW = 8
# Ids decoded at a time.
CHUNK = 16_384
# Texts whose results a worker holds at a time.
ROWS = 256

_NEVER = 1 << 40
# Bits of a way's number.
WAY = 40
_WAYS = (1 << WAY) - 1


class Merges:
    """Ranks of byte strings, which are their ids, with what follows from them: how a token is made, and which tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = token_list(ranks)
        self.edges: tuple[dict[int, array], dict[int, array]] = ({}, {})

    def merge(self, piece: bytes, least: int = 1) -> list[bytes]:
        """Tokens of a short string by merging step by step, down to `least` parts: the definition that the transducer must match."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if rank == _NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def made_of(self, token: bytes) -> tuple[bytes, ...] | None:
        """The two tokens whose merge, the last one, makes this token; None if it is one byte or merging never makes it."""
        parts = self.merge(token, 2)
        return tuple(parts) if len(parts) == 2 else None

    def reachable(self, token: bytes) -> bool:
        return token in self.ranks and (len(token) == 1 or self.made_of(token) is not None)

    def edge(self, token: int, side: int) -> array:
        """What stands at one end of a token (0: its left end, 1: its right end) while it is made, from a byte to the token.
        Each goes into the next at the next one's rank."""
        known = self.edges[side]
        if token not in known:
            made = self.made_of(self.tokens[token])
            known[token] = (self.edge(self.ranks[made[side]], side) if made else array("I")) + array("I", [token])
        return known[token]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens as they are when they stand side by side.

        Both grow from their bytes in the order of ranks; they stay apart if, as long as either still grows, no pair
        across the border comes first. At equal rank the leftmost merge comes first.
        """
        tokens, rank = self.tokens, self.ranks.get
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            across = rank(tokens[a[i]] + tokens[b[j]], _NEVER)
            grow_a = a[i + 1] if i + 1 < len(a) else _NEVER
            grow_b = b[j + 1] if j + 1 < len(b) else _NEVER
            if across < grow_a and across <= grow_b and across < _NEVER:
                return False
            if grow_a == grow_b == _NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1


class Transducer:
    """Bytes in, tokens out; states are made when first reached.

    A string has one encoding: the only cut into tokens of which all neighbours can stand side by side. A state holds every
    way to read the bytes so far: the tokens not yet emitted, and the place in the tree of tokens of the one being read.
    What all ways agree on is emitted, so a token goes out once the bytes after it leave no other reading; a way lives no
    longer than the longest token, which bounds states and lookahead. States are numbered; when the table of transitions
    is full, in the middle of a string too, it is begun anew from the state reached.

    Tables are few and flat, since a worker holds them all the time: the tree is one table by place and byte, its places are numbered along the
    sorted tokens, so that the tokens below a place are a range of them.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.sorted = array("I")  # ids along the sorted tokens
        self.tree: dict[int, int] = {}  # place * 256 + byte: the place below
        self.ends = array("i", [-1])  # by place: the token that ends there
        self.first, self.below = array("i", [0]), array("i", [0])  # by place: where the longer tokens that begin so start in `sorted`, their number
        for token in sorted(t for t in ranks if self.merges.reachable(t)):
            at = 0
            for b in token:
                self.below[at] += 1
                to = self.tree.setdefault(at << 8 | b, len(self.ends))
                if to == len(self.ends):
                    self.ends.append(-1)
                    self.first.append(len(self.sorted))
                    self.below.append(0)
                at = to
            self.ends[at] = ranks[token]
            self.sorted.append(ranks[token])
            self.first[at] = len(self.sorted)
        self.moves: dict[int, int] = {}
        if (len(ranks) + 1) * len(self.ends) > _WAYS:
            raise ValueError("too large a vocabulary")
        self.restart()

    def restart(self) -> None:
        # Runs of tokens that are held or emitted, by number; 0 is none.
        self.runs: list[tuple[int, ...]] = [()]
        self.run_numbers: dict[tuple[int, ...], int] = {(): 0}
        # A state: its ways, each with the number of its tokens not emitted yet in the bits above. Its transitions by state * 256 + byte: the next
        # state, and in the bits above it the number of what is emitted.
        self.states: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.table: dict[int, int] = {}
        self.number((0,))

    def number(self, state: tuple[int, ...]) -> int:
        to = self.numbers.setdefault(state, len(self.states))
        if to == len(self.states):
            self.states.append(state)
        return to

    def run(self, tokens: tuple[int, ...]) -> int:
        to = self.run_numbers.setdefault(tokens, len(self.runs))
        if to == len(self.runs):
            self.runs.append(tokens)
        return to

    def move(self, key: int) -> int:
        """What a way, (token before + 1) * places + place, meets at a byte, made for the first time: the way on, and in the bits above the token
        that ends here + 1, 0 for none. A way is given up, 0, where no token of these bytes can follow."""
        last, place = divmod(key >> 8, len(self.ends))
        to, made = self.tree.get(place << 8 | key & 255), 0
        if to is not None:
            adjacent = self.merges.adjacent
            if self.ends[to] >= 0 and (not last or adjacent(last - 1, self.ends[to])):
                made = self.ends[to] + 1 << WAY
            n, at = self.below[to], self.first[to]
            if n and (not last or n > FEW or any(adjacent(last - 1, t) for t in self.sorted[at : at + n])):
                made |= last * len(self.ends) + to
        if len(self.moves) >= MOVES:
            self.moves.clear()
        self.moves[key] = made
        return made

    def step(self, number: int, byte: int) -> int:
        """Next state and what is emitted, made for the first time."""
        known, runs, places = self.moves.get, self.runs, len(self.ends)
        ways: list[tuple[tuple[int, ...], int]] = []
        for packed in self.states[number]:
            held, way = runs[packed >> WAY], packed & _WAYS
            move = known(way << 8 | byte)
            if move is None:
                move = self.move(way << 8 | byte)
            if move & _WAYS:
                ways.append((held, move & _WAYS))
            if token := move >> WAY:
                ways.append(((*held, token - 1), token * places))
        out: tuple[int, ...] = ()
        if first := ways[0][0]:
            n = 0
            while n < len(first) and all(held[n : n + 1] == first[n : n + 1] for held, _ in ways):
                n += 1
            out = first[:n]
        n = len(out)
        to = self.number(tuple([self.run(held[n:]) << WAY | way for held, way in ways]))
        self.table[number << 8 | byte] = made = self.run(out) << 32 | to
        return made

    def encode(self, piece: bytes) -> array:
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return array("I", [whole])  # as the library has it: a piece that is a token is that token
        state, out, known, runs = 0, array("I"), self.table.get, self.runs
        for byte in piece:
            to = known(state << 8 | byte)
            if to is None:
                if len(self.table) >= TRANSITIONS:
                    ways = [(runs[w >> WAY], w & _WAYS) for w in self.states[state]]
                    self.restart()
                    state, known, runs = self.number(tuple([self.run(held) << WAY | way for held, way in ways])), self.table.get, self.runs
                to = self.step(state, byte)
            if to >> 32:
                out.extend(runs[to >> 32])
            state = to & 0xFFFFFFFF
        # At the end one way stands between two tokens: the encoding.
        out.extend(next((runs[w >> WAY] for w in self.states[state] if not (w & _WAYS) % len(self.ends)), ()))
        return out


class Encoder(dict):
    """Packed ids (little-endian unsigned 32-bit) of each piece; encoded when first asked for.

    When the table has grown to REMEMBERED bytes it becomes the older one, and pieces that are met again move on from there.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = SPLIT):
        super().__init__()
        self.transducer, self.pieces = Transducer(ranks), Pieces(pattern)
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            numbers = self.transducer.encode(piece.encode("utf-8", "surrogatepass"))
            if sys.byteorder == "big":
                numbers.byteswap()
            ids = numbers.tobytes()
        if len(piece) <= LONGEST:
            if self.held >= REMEMBERED:
                self.older, self.held = dict(self), 0
                self.clear()
            self.held += sys.getsizeof(piece) + sys.getsizeof(ids) + 100  # about what an entry takes in the table
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


class Utf8Stream:
    """UTF-8 decoding in pieces: an incomplete character at the end of one piece waits for the next.

    The state is what the last bytes have begun: how many bytes a character still needs. Bytes that can't belong to a
    character become U+FFFD, as bytes.decode("utf-8", "replace") does.
    """

    def __init__(self):
        self.waiting = b""

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could complete."""
        for n in range(1, min(3, len(data)) + 1):
            lead = data[-n]
            if lead & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
            if need <= n:
                return 0
            second = data[-n + 1] if n > 1 else None
            # Second bytes that would make an overlong form, a surrogate or a value beyond U+10FFFF.
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
            return n if second is None or low <= second <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        held = self.open_bytes(data)
        self.waiting = data[len(data) - held :] if held else b""
        return (data[: len(data) - held] if held else data).decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Iterable[bytes], tokens: list[bytes]) -> Iterator[str]:
    """Text of packed ids that come in pieces, a piece at a time."""
    stream = Utf8Stream()
    for packed in ids:
        for at in range(0, len(packed), 4 * CHUNK):
            numbers = array("I", packed[at : at + 4 * CHUNK])
            yield stream.feed(b"".join(map(tokens.__getitem__, numbers)))
    yield stream.close()


def token_list(ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens by id."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tokens


def _parts(column: pa.Array) -> Iterator[list]:
    """A batch in short lists, so that a worker holds the results of few texts at a time."""
    for at in range(0, len(column), ROWS):
        yield column.slice(at, ROWS).to_pylist()


def with_token_ids(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", pattern: str = SPLIT) -> DataFrame:
    """Add the token ids of a text as packed little-endian unsigned 32-bit integers (binary), the form token files have.

    `vocabulary` is a .tiktoken file of the driver; its ranks are broadcast (as many as it lists). Each match of `pattern`
    is encoded on its own, without special tokens. A null text is read as empty and has no ids. A column named `out` is
    replaced. Each text is encoded whole where it lies: no shuffle.
    """
    spark = ship(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    key = ("encode", vocabulary, pattern)

    @F.arrow_udf(T.BinaryType())
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept("codec", key, lambda: Encoder(ranks.value, pattern))
        for column in columns:
            for texts in _parts(column):
                yield pa.array([encoder.encode(t) if t else b"" for t in texts], pa.binary())

    return df.withColumn(out, encode(F.col(text)))


def with_decoded(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of packed token ids. Null ids give null, no ids an empty text; bytes that are no UTF-8 become U+FFFD.

    A column named `out` is replaced. An id outside the vocabulary fails the job.
    """
    spark = ship(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    key = ("decode", vocabulary)

    @F.arrow_udf(T.StringType())
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = kept("codec", key, lambda: token_list(ranks.value))
        for column in columns:
            for packed in _parts(column):
                yield pa.array([None if p is None else "".join(decode_stream([p], tokens)) for p in packed], pa.string())

    return df.withColumn(out, decode(F.col(ids)))


def with_round_trip(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", pattern: str = SPLIT) -> DataFrame:
    """`with_token_ids`, and `with_decoded` of its result, in one pass: each text is encoded, and its ids are decoded again, by one worker."""
    spark = ship(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    kind = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    @F.arrow_udf(kind)
    def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept("codec", ("encode", vocabulary, pattern), lambda: Encoder(ranks.value, pattern))
        tokens = encoder.transducer.merges.tokens
        for column in columns:
            for texts in _parts(column):
                packed = [encoder.encode(t) if t else b"" for t in texts]
                text_again = pa.array(["".join(decode_stream([p], tokens)) for p in packed], pa.string())
                yield pa.StructArray.from_arrays([pa.array(packed, pa.binary()), text_again], ["ids", "decoded"])

    df = df.withColumn("__both", both(F.col(text)))
    return df.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.decoded")}).drop("__both")
