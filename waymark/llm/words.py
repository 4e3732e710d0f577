"""Words of many texts at once, as numpy arrays: where they are and a 64-bit hash of each.

A word is a run of bytes other than space and \\t..\\r (0x09-0x0D). The hash of a byte string is a sum of random
64-bit values per byte times powers of an odd number (mod 2**64), finished by a mixing step; as prefix sums are
shared, hashes of all words and of all their prefixes cost one pass over the bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .cluster import slices

_U = np.uint64
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1 << 63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = np.random.default_rng(77).integers(1 << 63, size=64, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: Bytes whose prefix sums are held at once.
BLOCK = 1 << 20
#: Windows that are hashed at once.
WINDOWS = 1 << 18


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..BLOCK of the base and of its inverse."""
    return _powers(BLOCK + 1)


class Words:
    """Words of the texts whose bytes are ``data[offsets[i]:offsets[i + 1]]``.

    ``start``, ``end``: byte positions of each word; ``doc``: its text's number; ``first``: number of each text's
    first word, with one more entry at the end. ``data`` is lower-cased (A-Z) unless ``lower`` is False; another table
    of bytes that separate words can be given.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, separates: np.ndarray = _SEPARATES):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        # One byte per byte for what separates; positions in 32 bits wherever they fit.
        apart = separates[self.data]
        inner = offsets[(offsets > 0) & (offsets < n)]
        place = np.int32 if n < 1 << 31 else np.int64
        edge = np.ones(n + 1, bool)
        edge[1:n] = apart[:-1] if n else True
        edge[inner] = True
        edge[:n] &= ~apart
        self.start = np.flatnonzero(edge[:n]).astype(place)
        edge[:] = True
        edge[1:n] = apart[1:] if n else True
        edge[inner] = True
        edge[1:] &= ~apart
        edge[0] = False
        self.end = np.flatnonzero(edge).astype(place)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count), dtype=np.int32), self.count)
        self._sum: np.ndarray | None = None

    def _block(self, lo: int) -> np.ndarray:
        """Prefix sums from ``lo`` over BLOCK bytes, with the powers counted from ``lo``."""
        part = self.data[lo : lo + BLOCK]
        x = _BYTE[part]
        x *= powers()[0][: len(part)]
        out = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(x, out=out[1:])
        return out

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each byte span; equal spans have equal hashes. Starts ascend, and so do ends."""
        n = len(self.data)
        if n <= BLOCK:
            if self._sum is None:
                self._sum = self._block(0)
            x = self._sum[end]
            x -= self._sum[start]
            x *= powers()[1][start]
        else:
            x = np.empty(len(start), np.uint64)
            for lo in range(0, n, BLOCK):
                a, b = np.searchsorted(start, (lo, lo + BLOCK))
                if a < b:
                    self._hash_block(lo, start[a:b] - lo, end[a:b] - lo, x[a:b])
        x += (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
        return mix(x)

    def _hash_block(self, lo: int, start: np.ndarray, end: np.ndarray, out: np.ndarray) -> None:
        """Sums of spans that start in the block from ``lo``; of the few that go on behind it the rest is added block by block."""
        sums, inverse = self._block(lo), powers()[1]
        inside = np.minimum(end, len(sums) - 1)
        out[:] = (sums[inside] - sums[start]) * inverse[start]
        for i in np.flatnonzero(inside < end).tolist():
            total, first, last = int(out[i]), int(start[i]), int(end[i])
            for at in range(BLOCK, last, BLOCK):
                rest = self._block(lo + at)
                total += int(rest[min(last - at, len(rest) - 1)]) * pow(_BASE, at - first, 1 << 64)
            out[i] = total % (1 << 64)

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def windows(self, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``k`` words and the text of each.

        ``whole``: a text of 1 to k-1 words has one window, its whole sequence; otherwise it has none.
        """
        h, n = self.hashes(), len(self.start)
        m = max(0, n - k + 1)
        x = np.empty(m, np.uint64)
        for lo in range(0, m, WINDOWS):
            hi = min(m, lo + WINDOWS)
            y = h[lo:hi] * _PLACE[0]
            for j in range(1, k):
                y += h[lo + j : hi + j] * _PLACE[j]
            x[lo:hi] = mix(y)
        doc = self.doc[:m]
        if len(self.count) > 1:
            full = doc == self.doc[k - 1 : k - 1 + m]
            doc, x = doc[full], x[full]
        short = np.flatnonzero((self.count > 0) & (self.count < k)) if whole else np.zeros(0, int)
        if len(short):
            y = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = self.count[short] > j
                y[has] += h[self.first[short[has]] + j] * _PLACE[j]
            y = mix(y ^ self.count[short].astype(np.uint64))
            at = np.searchsorted(doc, short)
            x, doc = np.insert(x, at, y), np.insert(doc, at, short)
        return x, doc


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text, the sorted hashes of its distinct k-word shingles; empty without words. Texts are taken in runs of
    about SLICE_BYTES; a longer one takes some 8 bytes a byte."""
    out = []
    for lo, hi in slices(offsets):
        x, doc = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]).windows(k)
        at = np.searchsorted(doc, np.arange(hi - lo + 1))
        for a, b in zip(at[:-1], at[1:], strict=True):
            s = x if hi - lo == 1 else x[a:b].copy()
            s.sort()
            if len(s) > 1:
                new = np.empty(len(s), bool)
                new[0] = True
                np.not_equal(s[1:], s[:-1], out=new[1:])
                s = s[new]
            out.append(s)
    return out


def cuts(data: np.ndarray, separates: np.ndarray, limit: int) -> list[int]:
    """Places that cut a text into pieces of at most ``limit`` bytes before bytes that separate, the ends included; a
    stretch without one that is longer stays whole."""
    out, at, n = [0], 0, len(data)
    while n - at > limit:
        places = np.flatnonzero(separates[data[at + 1 : at + limit]])
        step = limit
        while not len(places) and at + step < n:
            places = np.flatnonzero(separates[data[at + step : at + 2 * step]]) + step - 1
            step *= 2
        if not len(places):
            break
        at += 1 + int(places[-1] if step == limit else places[0])
        out.append(at)
    if out[-1] < n:
        out.append(n)
    return out
