"""Secrets in texts: fixed patterns, and strings in a sensitive context that do not compress against what surrounds them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.deploy import ship

# The base patterns, in the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"secret|token|passw|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential|signature|session[_-]?id|cookie|client[_-]?id", re.IGNORECASE | re.ASCII)
LEAST = 12  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")

# What code is made of. Strings that it explains are no news.
IDENTIFIERS = (
    "import from return class def function const let var public private static void int string bool boolean float double long char "
    "true false null none self this new delete async await lambda yield try except catch finally throw raise if else elif for while "
    "print println printf console.log logger.info logging.getLogger(__name__) os.environ.get( process.env. System.getenv( config.get( "
    "username user_name user_id password passwd secret_key access_key api_key api_token auth_token bearer_token refresh_token client_id "
    "client_secret private_key public_key session_id cookie credential credentials signature authorization Authorization: Bearer Content-Type: "
    "application/json charset=utf-8 https://www. http://localhost:8080/ example.com github.com Mozilla/5.0 text/html name value type data "
    "result response request headers params options settings default index length count number object array list dict map key items "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ changeme placeholder your_api_key_here your-token-here xxxxxxxxxxxxxxxx "
    "get_password set_password reset_password_token password_confirmation token_expired_at csrf_token verification_token TOKEN_EXPIRATION_SECONDS"
)


@dataclass(frozen=True)
class Novelty:
    """When a candidate is reported.

    `reach`: characters after a sensitive word in which it may start; `around`: characters of text on either side that it is
    measured against; `least`: marginal compressed bytes; `share`: of these for each character.
    """

    reach: int = 48
    around: int = 256
    least: int = 12
    share: float = 0.7
    identifiers: str = IDENTIFIERS


class Meter:
    """Marginal compressed bytes of a string, given the text around it and a dictionary."""

    def __init__(self, identifiers: str):
        import zstandard

        words = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.squeeze = zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False, write_dict_id=False).compress

    def __call__(self, text: str, start: int, end: int, around: int) -> int:
        before, after = text[max(0, start - around) : start], text[end : end + around]
        known = (before + after).encode("utf-8", "surrogatepass")
        return len(self.squeeze(known + text[start:end].encode())) - len(self.squeeze(known))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; a match that fails a length test is dropped, and still uses up its text."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


class _Taken:
    """Whether a span meets one of the given ones, by bisection."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = sorted(s for s, _, _ in spans)
        self.ends = list(accumulate((e for _, e in sorted((s, e) for s, _, e in spans)), max))

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start


def novel_spans(text: str, taken: list[tuple[int, int, int]], meter: Meter, rule: Novelty) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, marginal bytes) of strings in a sensitive context, outside `taken`, that hold letters and digits and do not compress.

    A string is a run of CANDIDATE's characters: as a whole if a sensitive word ends at most `reach` before it, else what follows the last
    sensitive word inside it. It is reported once, at the first of these starts that passes. Words and runs are walked side by side: each is read once.
    """
    words = [m.end() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    out, others, low, high = [], _Taken(taken), 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while low < len(words) and words[low] <= start:
            low += 1  # words[:low] end before the run
        high = max(high, low)
        while high < len(words) and words[high] <= end - LEAST:
            high += 1  # words[low:high] end inside it and leave enough of it
        starts = [start] if low and start - words[low - 1] <= rule.reach else []
        for at in (*starts, words[high - 1]) if high > low else starts:
            value = text[at:end]
            if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value) or others.meets(at, end):
                continue
            size = meter(text, at, end, rule.around)
            if size >= rule.least and size >= rule.share * len(value):
                out.append((at, 3, end, size))
                break
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("kind", T.StringType()), ("start", T.LongType()), ("end", T.LongType()), ("novel_bytes", T.LongType()))]))
_meters: dict = {}


def with_secrets(df: DataFrame, text: str = "text", out: str = "secrets", rule: Novelty = Novelty()) -> DataFrame:
    """Add array<struct<kind, start, end, novel_bytes>>: spans in code points (end exclusive), by start, then kind.

    Kinds `assign`, `access` and `hex` come from fixed patterns, leftmost and without overlap within a kind. Kind `novel` is a
    string near a sensitive word, outside the spans of the others, whose marginal size by zstandard, primed with identifiers
    and the text around it, says that nothing explains it; `novel_bytes` is that size and null for the other kinds. A null or
    empty text has no spans. A column named `out` is replaced. Texts are searched whole, where they lie: no shuffle.
    """
    ship(df.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novel_bytes", pa.int64())]))

    def spans(text: str | None) -> list[dict]:
        if not text:
            return []
        base = base_spans(text)
        found = sorted([(*s, None) for s in base] + novel_spans(text, base, _meters[rule], rule), key=lambda s: s[:3])
        return [{"kind": KINDS[k], "start": s, "end": e, "novel_bytes": n} for s, k, e, n in found]

    @F.arrow_udf(_SPANS)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if rule not in _meters:
            _meters[rule] = Meter(rule.identifiers)
        for texts in batches:
            yield pa.array([spans(t.as_py()) for t in texts], kind)

    return df.withColumn(out, search(F.col(text)))
