"""Vector codes, page texts and repaired conversations against plain versions, and on odd rows."""

import hashlib
import html
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from chatmill.llm import queries, turn_repair
from chatmill.llm.labelled_pages import labelled_pages
from chatmill.llm.page_text import DEPTH, blocks_of, features_of, is_main, learn_tree, own_tree, page_blocks, with_page_text
from chatmill.llm.turn_repair import END, closing, digests, repair, repair_conversations
from chatmill.llm.value_codes import LARGEST, compress, decompress, nearest_entries

SMALL = "/root/testdata/sf0.001"


# Vector codes


def brute_codes(rows, parts, entries, rounds):
    """rows: (key, integers), in order of key. Codes, errors and codebooks by comparing every part with every entry."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(xs) // len(groups[i]) for xs in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return [bytes(i for _, i in f) for f in found], [sum(d for d, _ in f) for f in found], books


def test_codes_match_comparing_all_entries(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.4) if rng.random() < 0.9 else 0.0 for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, v) for i, (_, v) in enumerate(rows[:20])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got, books = compress(df, parts=4, entries=16, rounds=3)
    numbers = [(k, [math.floor(float(np.float32(x)) * 256) for x in v]) for k, v in rows]
    codes, errors, plain = brute_codes(numbers, 4, 16, 3)
    assert books.tolist() == plain
    assert [(r.vec_id, bytes(r.code), r.error) for r in got.orderBy("vec_id").collect()] == [(k, c, e) for (k, _), c, e in zip(rows, codes, errors, strict=True)]
    near = {r.vec_id: r.decoded for r in decompress(got, books).collect()}
    for (k, v), e in zip(rows, errors, strict=True):
        assert sum((a * 256 - b * 256) ** 2 for a, b in zip(v, near[k], strict=True)) <= e + 2 * math.sqrt(8 * e) + 8  # within a cell's width in each dimension


def test_value_dictionaries():
    rng = np.random.default_rng(2)
    part, entries = rng.integers(-300, 300, (5000, 3)), rng.integers(-300, 300, (64, 3))
    entries[7] = entries[3]
    gaps = ((part[:, None] - entries[None]) ** 2).sum(axis=2)
    best, gap = nearest_entries(part, entries)
    assert (best == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()
    assert 7 not in best  # a tie goes to the lower index


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0] * 4, "a", 1), (1, [0.5, 1.0, 2.0, 3.0], "b", 2), (None, [0.5] * 4, "c", 3), (2, None, "d", 4), (3, [nan, 0.0, 0.0, 0.0], "e", 5), (4, [inf, 0.0, 0.0, 0.0], "f", 6)]
    rows += [(5, [None, 0.0, 0.0, 0.0], "g", 7), (6, [], "h", 8), (7, [3e38, -3e38, 0.0, 0.0], "i", 9), (1, [0.5, 1.0, 2.0, 3.0], "b", 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string, key int")
    got, books = compress(df, parts=2, entries=8)
    assert got.columns == ["vec_id", "embedding", "key", "code", "error"]
    out = got.collect()
    assert sorted(r.key for r in out) == [1, 2, 2, 3, 9] and all(len(r.code) == 2 for r in out)
    assert all(r.error == 0 for r in out)  # as many entries as rows
    assert books.shape == (2, 5, 2) and books.max() == LARGEST
    nothing, none = compress(df.limit(0))
    assert nothing.collect() == [] and none.size == 0
    assert compress(df.filter("key in (4, 8)")).rows.collect() == []
    with pytest.raises(ValueError, match="components"):
        compress(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "vec_id long, embedding array<float>"), parts=1)
    with pytest.raises(ValueError, match="equal parts"):
        compress(df.filter("key = 1"), parts=3)


# Page texts


@pytest.fixture(scope="module")
def tree(spark):
    return own_tree(spark)


def text_of(tree, page):
    blocks = blocks_of(page)
    return " ".join(b.text for b, f in zip(blocks, features_of(blocks), strict=True) if is_main(tree, f))


def test_blocks():
    page = "<!DOCTYPE html><title>No</title><p>a<b>b</b> c &amp; d&nbsp;&#233;<br>e<p>two <!-- x --> words<div>three<span> four</span></div>a < b<script>if (a < b) '</p>'</script><ul><li>i<li><a href='x>y'>ii</a></ul>"
    assert [b.text for b in blocks_of(page)] == ["ab c & d é e", "two words", "three four", "a < b", "i", "ii"]
    assert [(b.words, b.linked) for b in blocks_of(page)][-2:] == [(1, 0), (1, 1)]
    assert [b.text for b in blocks_of("x</p></div>y<!-- never closed <p>z")] == ["x", "y"]
    assert [b.text for b in blocks_of("<p>a</p><a href=\"never closed>b</a>")] == ["a"]
    assert [b.text for b in blocks_of("<STYLE>p{}</style ><P CLASS=x>q</P><textarea>r</textarea>s&am")] == ["q", "s&am"]
    assert blocks_of(None) == blocks_of("") == blocks_of("<div> \n </div>") == []


def test_time_is_linear_in_odd_pages():
    import time

    for piece in ('<a "', "<!--", "<p", "<a href='x", "<b>", "<div>", "</x>", "<script>", "<div class='a b'>", "<li>", "<ul><li>", "<", "<p>x", "<a class=", "<td><p>", "&#1", "<button><div>", "<a>"):
        start = time.process_time()
        blocks_of(piece * 100_000)
        assert time.process_time() - start < 4, piece
    assert blocks_of("<div>" * 3 * DEPTH + "deep" + "</div>" * 3 * DEPTH + "<p>after")[-1].text == "after"


def test_tree_learns_its_table(tree):
    pages = labelled_pages()
    assert len(pages) < 100 and sum(len(k) for _, k in pages) < 1000
    for page, kept in pages:
        assert [is_main(tree, f) for f in features_of(blocks_of(page))] == kept


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        # Layouts that are not in the table the tree learned from.
        ("<body class='has-sidebar'><header><a href='/'>Daily Post</a></header><nav><a href=1>One</a> <a href=2>Two</a></nav><main id=content><h1>Rain</h1><p>It rained.</p><p>Yes.</p>"
         "<p>More of it is said to come on <a href=w>Wednesday</a>, if not before.</p></main><footer>All rights reserved</footer>", "Rain It rained. Yes. More of it is said to come on Wednesday, if not before."),
        ("<div class=cookie-consent>We use cookies to make this site work for all of you and more</div><article class='post hentry'><h2><a href=p>Bread at home</a></h2><p>Flour.</p>"
         "<ul><li>Water</li><li>Salt</li></ul><div class='share-buttons'>Share this</div></article><section id='comments'><p>I tried this bread at home and it was far too salty for all of us.</p></section>",
         "Bread at home Flour. Water Salt"),
        ("<form id=all><div id=sidebar-left>Something long about the people who write this page and why</div><article><p>Inside a form.</p></article></form>", "Inside a form."),
        ("<nav><ul><li><a href=a>Home</a><article><p>The menu was never closed.</p></article>", "The menu was never closed."),
        ("<article><p>Seen.</p><p hidden>Not seen.</p><p style='display: none'>Nor this.</p><noscript>Turn on scripts</noscript><p>Seen too", "Seen. Seen too"),
    ],
)
def test_other_layouts(tree, page, wanted):
    assert text_of(tree, page) == wanted


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")
def test_page_query_matches_cutting_out_the_article(spark):
    pages = {r.page_id: r for r in queries.table(spark, SMALL, "pages").collect()}
    got = queries.QUERIES["op12_page_text"](spark, SMALL).collect()
    assert len(got) == len(pages) and set(got[0].asDict()) >= {"page_id", "url", "text", "n_chars"}
    for r in got:
        article = re.search("<article>(.*?)(</article>|$)", pages[r.page_id].html, re.DOTALL)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_pages_of_odd_rows(spark):
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    rows = [(1, "<p>" + "main text of a page " * 9, "a", 1), (1, "<p>" + "main text of a page " * 9, "a", 1), (2, None, None, 2), (3, "", "t", 3), (4, "no markup at all", "t", 4), (5, long, "t", 5), (None, "<p>퟿😀", "t", 6)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, block int")
    got = with_page_text(df)
    assert got.columns == df.columns
    out = {r.block: r.text for r in got.collect()}
    assert out[1] == ("main text of a page " * 9).strip() and out[2] == out[3] == "" and len(out[5].split()) == 100_000
    assert with_page_text(df.limit(0)).collect() == []
    assert got.count() == len(rows)
    blocks = page_blocks(df.select("page_id", "html"))
    assert blocks.filter("page_id = 5").count() == 50_000 and blocks.filter("page_id = 1 and block.main").count() == 2
    empty = spark.createDataFrame([(None, [True]), ("<p>x</p>", None), ("<p>x</p>", [True, False])], "html string, main array<boolean>")
    assert learn_tree(empty) is False and learn_tree(empty.limit(0)) is False


# Repaired conversations


def brute_repair(rows):
    """rows: (letter, unfinished, must go). The least (cost, edits), from the last row back to the first."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(3):
            best = {s: min(best[s], (best[after[s, wanted[s]]][0] + 5, "I" + best[after[s, wanted[s]]][1])) for s in best}
        return best

    best = inserted({"": (0, ""), "s": (math.inf, ""), "u": (math.inf, ""), "a": (0, "")})
    for letter, unfinished, gone in reversed(rows):
        now = {}
        for s in best:
            ways = [(best[s][0] + 2, "D" + best[s][1])]
            if not gone:
                extra, to = 5 * unfinished, after[s, wanted[s]]
                ways.append((best[to][0] + 1 + extra, "R" + best[to][1]))
                if (s, letter) in after:
                    to = after[s, letter]
                    ways.append((best[to][0] + extra, "K" + best[to][1]))
            now[s] = min(ways)
        best = inserted(now)
    return best[""]


def code(letter, unfinished, gone):
    return turn_repair.LETTERS.index(letter) | 4 * unfinished | 8 * gone


def test_cheapest_edits():
    rng = random.Random(3)
    for _ in range(3000):
        rows = [(rng.choice("suua?a"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 17, 40]))]
        edits, state, cost = repair(bytes(code(*r) for r in rows))
        last = closing(state)
        assert (cost + 5 * len(last), "".join(edits) + last) == brute_repair(rows)


def test_blocks_are_chained():
    rng = random.Random(4)
    for _ in range(200):
        rows = [code(rng.choice("sua?"), rng.random() < 0.3, rng.random() < 0.3) for _ in range(30)]
        whole = repair(bytes(rows))
        cut = rng.randrange(31)
        ways = turn_repair.crossing(bytes(rows[cut:]))
        rest, _ = turn_repair._level(tuple(min(ways[4 * e + s] + END[e] for e in range(4)) for s in range(4)))
        first, state, cost = repair(bytes(rows[:cut]), rest)
        second, end, more = repair(bytes(rows[cut:]), END, state)
        assert (first + second, end, cost + more) == whole


def plain_digest(rows):
    """rows: (turn, role, text) of a conversation after damage. The columns of op13, by plain loops."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest(), len(r[1])))
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.strip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    letters = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "?" for r in rows]
    cost, audit = brute_repair([(a, f == "truncated", f in ("blank", "duplicate")) for a, f in zip(letters, faults, strict=True)])
    out, at, last = [], 0, ""
    for edit in audit:
        role = {"K": rows[at][1] if edit == "K" else ""}.get(edit, "assistant" if last == "u" else "user")
        if edit != "D":
            out.append(f"{role}:{'' if edit == 'I' else rows[at][2]}")
            last = role[:1]
        at += edit != "I"
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def digest_rows(df, key="conv_id"):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r[key]: tuple(r[c] for c in columns) for r in digests(repair_conversations(df, key), key).collect()}


def test_conversations_of_odd_rows(spark):
    rng = random.Random(5)
    texts, roles = ["Fine.", "no end", " \t", "", None, "Why?", "é\x0b!", "a" * 100_000 + "."], ["user", "assistant", "system", "tool", None, "", "User"]
    talks = {f"c{i}": [(rng.choice([None, *range(-2, 9)]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts)) for _ in range(rng.randrange(1, 14))] for i in range(300)}
    talks[None] = [(None, "user", "All turns are null."), (None, "user", "All turns are null."), (None, "assistant", "Yes.")]
    talks[""] = [(9223372036854775807, "user", "Far."), (-9223372036854775808, "assistant", "Away.")]
    rows = [(k, t, r, x, "extra", 1) for k, v in talks.items() for t, r, x in v]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, edits string, block int")
    got, want = digest_rows(df), {k: plain_digest(v) for k, v in talks.items()}
    assert got[""][0] is None and got[""][1:] == want[""][1:]  # more gaps than a long can hold
    assert {k: v for k, v in got.items() if k != ""} == {k: v for k, v in want.items() if k != ""}
    assert digest_rows(df.limit(0)) == {}


def test_a_long_conversation_spans_blocks_and_tasks(spark):
    rng = random.Random(6)
    long = [(i // 2 if i > 50 else None, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"text {i}.", f"cut {i}", "Again.", ""])) for i in range(30_000)]
    talks = {1: [(0, "user", "Hello.")], 2: long, 3: [(0, "user", "Hello.")] * 5000, 4: [(0, "user", "Hi."), (1, "assistant", "Oh.")]}
    rows = [(k, *r) for k, v in talks.items() for r in v]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    assert repair_conversations(df).filter("conv_id = 2").count() > 5
    assert digest_rows(df) == {k: plain_digest(v) for k, v in talks.items()}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")
def test_conversation_query_matches_plain_loops(spark):
    talks = {}
    for r in queries.table(spark, SMALL, "conversations").collect():
        f = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        row = (r.turn, "user" if f == 4 else r.role, "" if f == 1 else re.sub("[.!?]", "", r.text) if f == 2 else r.text)
        talks.setdefault(r.conv_id, []).extend([row] * (0 if f == 0 else 2 if f == 3 else 1))
    got = {r.conv_id: r for r in queries.QUERIES["op13_turn_repair"](spark, SMALL).collect()}
    assert set(got) == set(talks)
    for k, rows in talks.items():
        r = got[k]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == plain_digest(rows)
    roles = {}
    for r in repair_conversations(queries.table(spark, SMALL, "conversations")).orderBy("block").collect():
        roles[r.conv_id] = roles.get(r.conv_id, "") + "".join(t.role[:1] for t in r.turns)
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")
def test_copies_of_vectors_are_linked(spark):
    got = queries.QUERIES["near_vector_copies"](spark, SMALL).collect()
    assert all(r.n_links >= 2 and r.component_id <= r.vec_id - r.vec_id % 3 for r in got)
