"""Main text of web pages: flat text blocks, kept or left out by a decision tree over their lengths, links, neighbours and place."""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.deploy import ship

# Elements of HTML. The content of the first is no markup; the second have no content; the third are part of a line.
RAW = "script style title textarea xmp iframe noembed noframes".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
# What starts a new paragraph ends an open one; an item ends the item before it, up to the list both are in.
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SIBLINGS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
HEADINGS = {f"h{i}" for i in range(1, 7)}

# Parts of a page by element, role, or a word of the class or id: what is not the text, and what may be it.
ASIDE_ELEMENTS = set("nav aside footer form dialog noscript template svg math button select datalist object audio video canvas".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
ASIDE_WORDS = set(
    """ad ads advert adverts advertisement sponsor sponsored sponsors promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments
    commentlist disqus respond reply replies discussion related recommended recommendations widget search toolbar masthead topbar pagination pager copyright form""".split()
)
TEXT_ELEMENTS, TEXT_ROLES, TEXT_WORDS = {"article", "main"}, {"main", "article"}, set("article content post entry story main".split())
WITHOUT = {"has", "with", "no", "without"}  # `has-sidebar` is said of the part beside one

_GAP = r"[ \t\n\f\r]"
# Possessive and with an end at the text's end, so that nothing is read twice: time is linear in any page.
_TOKEN = re.compile(
    rf"""(?P<text>[^<]+)
    |<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<close>/?)(?P<name>[a-zA-Z][^ \t\n\f\r/>]*+)(?P<more>(?:[^>=]++|={_GAP}*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)
    |(?P<lone><)""",
    re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(rf"""(?<![^ \t\n\f\r/"'])(class|id|role|hidden|aria-hidden|style)(?:{_GAP}*={_GAP}*(?:"([^"]*)"|'([^']*)'|([^ \t\n\f\r"'>]+)))?(?![^ \t\n\f\r/])""", re.IGNORECASE)
_ENDS = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.IGNORECASE) for name in RAW}
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

# Where a block lies: in a part that is not the text, in none that is marked, in one that a class name calls the text, in one that an element or role does.
OUTSIDE, UNKNOWN, LIKELY, INSIDE = -1, 0, 1, 2

# Elements open at once; deeper ones belong to the last of these, as browsers have it too.
DEPTH = 500


class Block(NamedTuple):
    text: str
    words: int
    linked: int  # words inside links
    heading: bool
    place: int


def place_of(name: str, more: str, above: int, parents: list[str]) -> int:
    """Where the content of an element lies, from where the element lies."""
    words: set[str] = set()
    role = ""
    if more:
        for m in _ATTRIBUTE.finditer(more):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
                return OUTSIDE
            if key == "role":
                role = value.lower()
            elif key in ("class", "id") and name not in ("body", "html"):
                for one in value.split():
                    found = {w.lower() for w in _WORDS.findall(one)}
                    words |= found if not found & WITHOUT else set()
    if name in ASIDE_ELEMENTS or role in ASIDE_ROLES or words & ASIDE_WORDS:
        return OUTSIDE
    if name == "main" or role == "main":
        return INSIDE
    if name == "article" and above == OUTSIDE:
        # An article in a sidebar is a teaser; in a form or an unclosed menu it is the page's.
        return OUTSIDE if any(p in ("aside", "") for p in parents) else INSIDE
    if above == UNKNOWN and (name == "header" or words & {"header"}):
        return OUTSIDE
    if above != OUTSIDE and (name in TEXT_ELEMENTS or role in TEXT_ROLES):
        return INSIDE
    return LIKELY if above == UNKNOWN and words & TEXT_WORDS else above


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order: runs of text between elements that are no part of a line.

    Character references are decoded, runs of white space (no-break spaces among them) become one space. Comments, scripts and styles have no text; the
    page's title is none of its text either. Elements may be left open, closed twice or cut off by the end.
    """
    page = page or ""
    out: list[Block] = []
    # Open elements that count, each with the place of its content; a part known by its attributes alone stands in `outs` as "".
    names, places, outs = [""], [UNKNOWN], []
    opened: dict[str, int] = {}  # how many of a name are open
    texts: list[str] = []
    linked: list[str] = []
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal texts, linked
        if texts:
            words = references.unescape("".join(texts)).split()
            if words:
                out.append(Block(" ".join(words), len(words), min(len(words), len(" ".join(linked).split())), any(n in HEADINGS for n in names[-2:]), places[-1]))
            texts, linked = [], []

    def pop(to: int) -> None:
        for name in names[to:]:
            opened[name] -= 1
        del names[to:], places[to:]
        while outs and outs[-1][0] >= to:
            outs.pop()

    def last(wanted: tuple[str, ...], stop: tuple[str, ...]) -> int:
        for i in range(len(names) - 1, 0, -1) if any(opened.get(n) for n in wanted) else ():
            if names[i] in wanted:
                return i
            if names[i] in stop:
                break
        return 0

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m["name"]
        if name is None:
            text = m["text"] or m["lone"]
            if text:
                texts.append(text)
                if opened.get("a"):
                    linked.append(text)
            continue
        name = name.lower()
        if name == "br":
            texts.append(" ")
            continue
        line = name in INLINE
        if not line:
            flush()
        if m["close"]:
            if name == "a" or not line:
                i = last((name,), () if name != "p" else ("div", "article", "section", "td"))
                if i:
                    pop(i)
            continue
        if name in _ENDS:
            stop = _ENDS[name].search(page, at)
            at = stop.start() if stop else end
            continue
        if name in VOID or (line and name != "a"):
            continue
        if name == "a":
            i = last(("a",), ())
            if i:
                pop(i)
        else:
            i = last(("p",), ("td", "th", "button", "object"))
            if i:
                pop(i)
            if name in ITEMS and (i := last(SIBLINGS.get(name, (name,)), ITEMS[name])):
                pop(i)
        if len(names) > DEPTH:
            continue
        place = places[-1] if name == "a" else place_of(name, m["more"], places[-1], [n for _, n in outs])
        if place == OUTSIDE and places[-1] != OUTSIDE:
            outs.append((len(names), name if name in ASIDE_ELEMENTS or name == "header" else ""))
        names.append(name)
        opened[name] = opened.get(name, 0) + 1
        places.append(place)
    flush()
    return out


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "title", "place", "elsewhere")


def features_of(blocks: list[Block]) -> list[list[float]]:
    """A row of numbers for each block, see FEATURES: its words and the share of them in links, those of the blocks before and after it, whether it is a
    heading in the part marked as the text, its place, and whether the page marks another part as its text."""
    least = INSIDE if any(b.place == INSIDE for b in blocks) else LIKELY
    inside = sum(b.words for b in blocks if b.place >= least)
    if least == LIKELY and inside < sum(b.words - b.linked for b in blocks if b.place == UNKNOWN):
        inside = 0  # a class name alone, on the smaller part
    own = [(float(b.words), b.linked / b.words) for b in blocks]
    padded = [(0.0, 0.0), *own, (0.0, 0.0)]
    return [[*padded[i + 1], *padded[i], *padded[i + 2], float(b.heading and b.place >= least and inside > 0), float(b.place), float(inside > 0 and b.place < least)] for i, b in enumerate(blocks)]


# A leaf says whether a block is main text; else (feature, threshold, way up to it, way above it).
Tree = bool | tuple[int, float, "Tree", "Tree"]


def learn_tree(labelled: DataFrame, page: str = "html", main: str = "main", depth: int = 7) -> Tree:
    """Train the tree on pages with a list of booleans, one for each block: whether it is main text. Rows with nulls, and with lists of another length than
    the page has blocks, are left out; without any row the tree takes nothing for main text. Blocks are read and split on in tasks; only the tree comes back."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    ship(labelled.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[float]] = []
            labels: list[float] = []
            for html, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                features = features_of(blocks_of(html))
                if html is not None and kept is not None and len(kept) == len(features) and None not in kept:
                    found += features
                    labels += map(float, kept)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), pa.array(labels, pa.float64())], ["x", "label"])

    table = labelled.select(page, main).mapInArrow(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    if table.isEmpty():
        return False
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=1, seed=1).fit(table)

    def read(node) -> Tree:
        if node.subtreeDepth() == 0:
            return node.prediction() == 1.0
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    return read(model._java_obj.rootNode())


_trees: dict[str, Tree] = {}


def own_tree(spark: SparkSession) -> Tree:
    """The tree learned from the table in labelled_pages, once an application."""
    from chatmill.llm.labelled_pages import labelled_pages

    app = spark.sparkContext.applicationId
    if app not in _trees:
        _trees[app] = learn_tree(spark.createDataFrame(labelled_pages(), "html string, main array<boolean>"))
    return _trees[app]


def is_main(tree: Tree, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        feature, threshold, up_to, above = tree
        tree = up_to if features[feature] <= threshold else above
    return tree


def with_page_text(df: DataFrame, page: str = "html", name: str = "text", tree: Tree | None = None) -> DataFrame:
    """Add the main text of a page: its main blocks in order, joined by one space; empty for a null or empty page and for one without main text.

    Each page is read whole, on its own; nothing is shuffled. Other columns are handed on, whatever their names; `name` replaces a column of that name.
    """
    spark = ship(df.sparkSession)
    rules = own_tree(spark) if tree is None else tree

    @F.arrow_udf("string")
    def text_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for html in column.to_pylist():
                blocks = blocks_of(html)
                out.append(" ".join(b.text for b, f in zip(blocks, features_of(blocks), strict=True) if is_main(rules, f)))
            yield pa.array(out, pa.string())

    return df.withColumn(name, text_of(page))


def page_blocks(df: DataFrame, page: str = "html", tree: Tree | None = None) -> DataFrame:
    """The input's rows once for each text block of the page, with `block` (place in the page from 0, text, words, linked words, heading, place and whether
    it is main text); pages without text have no row."""
    spark = ship(df.sparkSession)
    rules = own_tree(spark) if tree is None else tree
    kind = pa.list_(pa.struct([("at", pa.int32()), ("text", pa.string()), ("words", pa.int32()), ("linked", pa.int32()), ("heading", pa.bool_()), ("place", pa.int32()), ("main", pa.bool_())]))

    @F.arrow_udf("array<struct<at: int, text: string, words: int, linked: int, heading: boolean, place: int, main: boolean>>")
    def cut(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for html in column.to_pylist():
                blocks = blocks_of(html)
                out.append([b._asdict() | {"at": i, "main": is_main(rules, f)} for i, (b, f) in enumerate(zip(blocks, features_of(blocks), strict=True))])
            yield pa.array(out, kind)

    return df.withColumn("__blocks", cut(page)).withColumn("block", F.explode("__blocks")).drop("__blocks")
