"""Words of whole texts as 64-bit hashes, a batch of documents at a time.

A word is ``[^\\x20\\x09-\\x0D]+``. On UTF-8 bytes that is exactly ``bytes.split()``, and
``bytes.lower()`` lowers A-Z only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()

#: Everything that a worker remembers between tasks.
REMEMBERED: list[dict] = [HASHES]


def only(*kept: dict) -> None:
    """Forget what other operations of this worker have remembered."""
    for other in REMEMBERED:
        if not any(other is x for x in kept):
            other.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes], known: WordHashes = HASHES) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


#: Bytes that are hashed at a time.
_AT_ONCE = 1 << 20
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_P, _AT_ONCE), _powers(_P_INVERSE, _AT_ONCE)


def hashed_words(texts: list[bytes]) -> tuple[list[int], bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Of several texts, one after another: the number of words of each, all bytes, and where each word
    begins, where it ends, and its hash. A hash is a polynomial of the word's bytes, by prefix sums."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, np.uint8)
    edge = np.diff(_SPACE[data].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    stops = np.cumsum([len(t) + 1 for t in texts])
    sizes = np.diff(np.searchsorted(begins, stops), prepend=0).tolist()
    hashes, i = np.empty(len(begins), np.uint64), 0
    while i < len(begins):
        at = begins[i]
        k = max(i + 1, int(np.searchsorted(ends, at + _AT_ONCE, "right")))  # a longer word by itself
        n = int(ends[k - 1] - at)
        up, down = (_UP, _DOWN) if n <= _AT_ONCE else (_powers(_P, n), _powers(_P_INVERSE, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[at : at + n] + np.uint64(1)) * down[:n], out=sums[1:])
        hashes[i:k] = (sums[ends[i:k] - at] - sums[begins[i:k] - at]) * up[begins[i:k] - at]
        i = k
    return sizes, joined, begins, ends, mix(hashes)


def runs(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One hash for each run of n words from ``first`` on, the number of words included."""
    out = np.empty(len(first), np.uint64)
    for k in np.unique(n).tolist():
        at = np.flatnonzero(n == k)
        acc = np.full(len(at), np.uint64(k))
        for j in range(k):
            acc *= _P
            acc += hashes[first[at] + j]
        out[at] = mix(acc)
    return out


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words (order counts)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = hashes[:n].copy()
    for k in range(1, width):
        acc *= _P
        acc += hashes[k : k + n]
    return mix(acc)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
