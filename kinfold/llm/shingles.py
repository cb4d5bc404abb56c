"""Word shingles as sorted 64-bit hashes, for operators on word sets."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
CACHED_WORDS = 500_000      # distinct words remembered per worker

_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over 64 bits (a finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash; forgets everything once it holds CACHED_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words(text: str) -> list[bytes]:
    """Words of the contracts: bytes.lower() touches A-Z alone, bytes.split() cuts at
    exactly the white space 0x09-0x0D and 0x20."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, hashes: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the `width`-word shingles; fewer words are one shingle."""
    parts = words(text or "")
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, n)
    width = min(width, n)
    out = h[: n - width + 1].copy()
    for k in range(1, width):
        out *= _P
        out += h[k: n - width + 1 + k]
    out = mix(out + np.uint64(width))
    out.sort()
    keep = np.empty(len(out), bool)
    keep[0] = True
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))
