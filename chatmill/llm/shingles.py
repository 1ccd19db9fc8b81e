"""Words and word shingles as 64-bit numbers, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

# Words remembered by a Python worker; it bounds its memory only.
REMEMBERED = 250_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z as a-z, in UTF-8. bytes.lower() and bytes.split() do just that."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordNumbers(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit numbers of the runs of `size` words; of the whole sequence if it is shorter; of none, none.

    Different shingles of the same text or of two texts compared get the same number with a chance of about n * n / 2 ** 65
    for n shingles.
    """
    n = len(words)
    if n == 0:
        return words
    k = min(size, n)
    total = np.full(n - k + 1, k, np.uint64) * _ODD
    for i in range(k):
        total = mixed(total + words[i : n - k + 1 + i]) * _ODD
    return np.unique(mixed(total))
