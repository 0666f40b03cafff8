"""Words and word shingles of whole texts as 64-bit numbers, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Entries of a worker's word cache before it starts anew.
CACHE = 500_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_S = np.uint64(32)


class _WordIds(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = xxhash.xxh3_64_intdigest(word)
        self[word] = n
        return n


_ids = _WordIds()


def raw_words(text: str | None, lower: bool) -> list[bytes]:
    """Words between ASCII white space; ``lower`` folds A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_ids.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers."""
    x = x * _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


def shingles(ids: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of ``k`` words; a shorter text is one shingle, an empty one has none."""
    if len(ids) == 0:
        return ids
    k = min(k, len(ids))
    n = len(ids) - k + 1
    s = np.full(n, k, np.uint64)
    for i in range(k):
        s = mix(s + ids[i : i + n])
    return np.unique(s)
