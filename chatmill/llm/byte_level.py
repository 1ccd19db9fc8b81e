"""Byte-level vocabularies: reading vocabulary files and splitting text into the pieces that are merged on their own."""

from __future__ import annotations

import base64
import json
import re
from pathlib import Path

import regex

# Fixed value: the split of byte-level vocabularies. White space is named by its Unicode property, which the
# tokenizer libraries mean by \s; Python's own \s would also take U+001C to U+001F.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def splitter(pattern: str) -> regex.Pattern:
    """Compile a split pattern, reading \\s and \\S as the Unicode property."""
    inside = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(inside)


# Letters and numbers of Unicode versions after 16.0, which the tokenizer libraries know, as ranges of code points (hexadecimal). To them
# these are symbols; the splitting package here already knows them.
NEWER = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb
11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168
1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479
3d000-3fc3f""".split()
_newer = re.compile("[" + "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in NEWER) + "]")


class Pieces:
    """The pieces of a text, as the libraries split it."""

    def __init__(self, pattern: str):
        self.pattern = splitter(pattern)

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not _newer.search(text):
            return self.pattern.findall(text)
        # A symbol in place of each newer letter gives the places to split at.
        return [text[m.start() : m.end()] for m in self.pattern.finditer(_newer.sub("\u2603", text))]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a .json vocabulary: itself if it prints, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_merges(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Of a .json vocabulary: the rank of each mergeable pair, and the strings taken whole before any split."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    letters = byte_letters()

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
    whole = [t["content"] for t in model.get("added_tokens", [])]
    return {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}, whole


def read_ranks(path: str) -> dict[bytes, int]:
    """Of a .tiktoken vocabulary: the rank, which is the id, of each token."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}
