"""Vectorised hashes of words, shingles and byte strings, by prefix sums of a polynomial modulo 2^64."""

from __future__ import annotations

import numpy as np

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: The powers made last, by their number.
_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _kept:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _kept.clear()
        _kept[n] = np.cumprod(up), np.cumprod(down)
    return _kept[n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PrefixHash:
    """Hashes of any byte range of a text from prefix sums: equal ranges have equal hashes."""

    def __init__(self, data: np.ndarray) -> None:
        n = 1 << max(10, int(len(data)).bit_length())
        self.up, self.down = _powers(n)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def raw(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k bytes from each position."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


#: ASCII capital letters to small ones, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes between white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: ASCII letters and digits, and every byte of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def words(offsets: np.ndarray, data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, document, start and end of every run of ``member`` bytes, lower-cased, never across documents."""
    inside = member[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = mix(PrefixHash(LOWER[data]).raw(starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def shingles(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and first word of every k-word shingle; a shorter document is one shingle."""
    n = len(hashes)
    long_enough = np.zeros(n, bool)
    if n >= k:
        long_enough[: n - k + 1] = doc[: n - k + 1] == doc[k - 1 :]
    at = np.flatnonzero(long_enough)
    h = np.full(len(at), k, np.uint64)
    for j in range(k):
        h = mix(h ^ hashes[at + j]) + np.uint64(j + 1)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if n else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, n])
    short = first[count < k]
    if not len(short):
        return h, doc[at], at
    size = count[count < k]
    g = size.astype(np.uint64)
    for j in range(k - 1):
        step = mix(g ^ hashes[np.minimum(short + j, n - 1)]) + np.uint64(j + 1)
        g = np.where(size > j, step, g)
    at = np.r_[at, short]
    order = np.argsort(at, kind="stable")
    return np.r_[h, g][order], doc[at][order], at[order]


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once for a document, sorted by document and hash."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
