import base64
import random
from array import array

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

from chatmill.llm.byte_level import read_merges, read_ranks
from chatmill.llm.codec import Encoder, Utf8Stream, decode_stream, with_decoded, with_round_trip, with_token_ids
from chatmill.llm.token_count import merged_length, text_counter, with_token_count

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
MULTI = P.path("byte_bpe_multi_50k.tiktoken")


def texts():
    rng = random.Random(1)
    letters = "abcdefghijkl 0123'\n\t\x1c\x85 éü😀中文ßþ.,!?\xa0ABC"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    wide = ["".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(30)) for _ in range(300)]
    return [*mixed, *wide, "", " ", "a" * 4000, "ab" * 3000, " " * 900, "x<|endoftext|>y <|endoftext|>", "it's they'll I'd"]


@pytest.fixture(scope="module")
def library():
    pairs = (line.split() for line in open(RANKS, "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_match_the_library():
    count, rows = text_counter(*read_merges(JSON)), texts()
    other = tokenizers.Tokenizer.from_file(JSON)
    assert [count(t) for t in rows] == [len(e.ids) for e in other.encode_batch(rows, add_special_tokens=False)]


def test_merging_takes_the_lowest_rank_then_the_leftmost():
    ranks = {(b"a", b"a"): 1, (b"aa", b"b"): 0}
    assert merged_length([b"a", b"a", b"a", b"b"], ranks) == 3  # aa a b
    assert merged_length([b"a", b"a", b"b"], ranks) == 1
    assert merged_length([], ranks) == 0


def test_encoding_matches_the_library(library):
    encoder = Encoder(read_ranks(RANKS), P.PATTERN)
    for t in texts():
        assert list(array("I", encoder.encode(t))) == library.encode_ordinary(t)


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_transducer_matches_merging(path):
    ranks = read_ranks(path)
    transducer, rng = Encoder(ranks).transducer, random.Random(2)
    for _ in range(4000):
        word = "".join(rng.choice("abcdefghinorst éüж") for _ in range(rng.randint(1, 24))).encode()
        assert [transducer.merges.tokens[i] for i in transducer.encode(word)] == ([word] if word in ranks else transducer.merges.merge(word))


def test_all_tokens_are_reached():
    ranks = read_ranks(RANKS)
    merges = Encoder(ranks).transducer.merges
    assert all(merges.reachable(t) for t in ranks)


def test_incremental_decoding():
    rng = random.Random(3)
    marks = [0x61, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xF4, 0x90, 0xC0, 0xFF]
    for _ in range(5000):
        data = bytes(rng.choice(marks) for _ in range(8))
        i = rng.randint(0, 8)
        stream = Utf8Stream()
        assert stream.feed(data[:i]) + stream.feed(data[i:]) + stream.close() == data.decode("utf-8", "replace")
    assert "".join(decode_stream([], [])) == ""


def test_operators_on_rows(spark, library):
    rows = [Row(doc_id=i, text=t, n_tokens="x", ids=1, decoded=0) for i, t in enumerate([*texts()[:50], None, "", "twice", "twice"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int, decoded int")
    got = with_decoded(with_token_ids(with_token_count(df, JSON), RANKS), RANKS)
    assert got.columns == df.columns
    for r in got.collect():
        ids = library.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert list(array("I", r.ids)) == ids
        assert r.decoded == (r.text or "")
    both = with_round_trip(df, RANKS)
    assert both.columns == df.columns
    assert sorted((r.doc_id, bytes(r.ids), r.decoded) for r in both.collect()) == sorted((r.doc_id, bytes(r.ids), r.decoded) for r in got.collect())
    assert with_token_count(df.limit(0), JSON).collect() == []
    assert with_decoded(df.select(F.lit(None).cast("binary").alias("ids")), RANKS).first().decoded is None


def test_one_long_word_takes_bounded_memory(library):
    import tracemalloc

    rng = random.Random(5)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    encoder = Encoder(read_ranks(RANKS))
    tracemalloc.start()
    ids = encoder.encode(word[:500_000])  # makes more transitions than a worker remembers
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 250e6
    assert list(array("I", ids)) == library.encode_ordinary(word[:500_000])
    assert list(array("I", encoder.encode(word))) == library.encode_ordinary(word)


def test_tables_are_begun_anew_within_a_word(library, monkeypatch):
    from chatmill.llm import codec

    monkeypatch.setattr(codec, "TRANSITIONS", 40)
    monkeypatch.setattr(codec, "MOVES", 30)
    monkeypatch.setattr(codec, "REMEMBERED", 2_000)
    encoder = Encoder(read_ranks(RANKS), P.PATTERN)
    for t in texts():
        assert list(array("I", encoder.encode(t))) == library.encode_ordinary(t)
        assert len(encoder.transducer.table) <= 40 and len(encoder.transducer.moves) <= 30


def test_newer_letters_are_symbols_as_in_the_libraries(library):
    from chatmill.llm.byte_level import NEWER

    other = tokenizers.Tokenizer.from_file(JSON)
    encoder, count = Encoder(read_ranks(RANKS), P.PATTERN), text_counter(*read_merges(JSON))
    for r in NEWER:
        first, last = (int(c, 16) for c in (r.split("-") * 2)[:2])
        for c in {first, last, (first + last) // 2}:
            text = f"a{chr(c)}'s {chr(c)}1b {chr(c)}{chr(c)}"
            assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)
            assert count(text) == len(other.encode(text, add_special_tokens=False).ids)
