"""Text clean-up shared by parsing and scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space by str.strip, str.split and \\s in Python: those with
# the Unicode property, and the four separators U+001C to U+001F. To be used in patterns with the flag U.
SPACE = r"\s\x1c-\x1f"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The line ends known to str.splitlines in Python.
LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"

THINK_BLOCK = "<think>.*?</think>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    Written as a one-element transform, so that `body` may use the value many times, also inside
    further lambdas, without Catalyst copying the expression to each place of use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Drop white space at both ends, with Python's idea of white space."""
    return F.trim(text, F.lit(SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def fold_spaces(text: Column) -> Column:
    """Turn every white space run into one space."""
    return F.regexp_replace(text, f"(?U)[{SPACE}]+", " ")


def normalize(text: Column) -> Column:
    """Lower-case, fold white space runs to one space, drop it at the ends."""
    return F.trim(fold_spaces(F.lower(text)))


def strip_thinking(text: Column) -> Column:
    """Remove reasoning blocks in any letter case (used before scoring text)."""
    return strip(F.regexp_replace(text, f"(?isu){THINK_BLOCK}", ""))


def strip_think_blocks(text: Column) -> Column:
    """Remove reasoning blocks in lower case only (used before reading JSON)."""
    return strip(F.regexp_replace(text, f"(?s){THINK_BLOCK}", ""))


def _cut_end(text: Column, mark: str) -> Column:
    """A stripped text without the mark at its end."""
    return F.when(text.endswith(mark), rstrip(F.substring(text, F.lit(1), F.length(text) - len(mark)))).otherwise(text)


def strip_code_fences(text: Column) -> Column:
    """Remove a backtick fence and then a tilde fence around the text."""
    text = _cut_end(F.regexp_replace(strip(text), rf"(?iU)\A```(?:json|python|text)?[{SPACE}]*", ""), "```")
    return strip(_cut_end(F.regexp_replace(text, rf"(?iU)\A~~~(?:json)?[{SPACE}]*", ""), "~~~"))


def truncate(text: Column, width: int = 45) -> Column:
    """Shorten a label to `width` characters, the last one an ellipsis."""
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.substring(text, 1, width - 1), F.lit("…")))
