"""Vectorised pre-tokenisation by the byte-level BPE pattern.

`split` cuts texts where the pattern
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
cuts them, from runs of equal character classes instead of a regex scan.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

from .kernels import _INV, _MUL, _ODD, mix

OTHER, LETTER, NUMBER, SPACE = range(4)
#: What may follow an apostrophe as a piece of its own (fixed values, in the pattern's order).
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and random value of every code point."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = points.astype(np.uint32).tobytes().decode("utf-32-le")
    classes = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            classes[points[m.start():m.end()]] = kind
    return classes, mix(np.arange(1, 0x110001, dtype=np.uint64) * _MUL)


def split(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(joined text, piece starts, piece ends, pieces before each text).

    Positions count code points of the joined text; the last array has one
    entry more than `texts`.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    n = len(points)
    if n == 0:
        return joined, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kind = _tables()[0][points]
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    edge[1:n] = kind[1:] != kind[:-1]
    edge[bounds] = True
    text_end = np.zeros(n + 1, bool)
    text_end[bounds] = True
    s = np.flatnonzero(edge[:n])
    e = np.append(s[1:], n)
    k = kind[s]
    closed = text_end[e]
    blank = points == 32

    cut = np.zeros(n + 1, bool)
    space = k == SPACE
    ends_blank = blank[e - 1]
    cut[s[space & (closed | (e - s > 1) | ~ends_blank)]] = True
    cut[e[space & ~closed & ~ends_blank & (e - s > 1)] - 1] = True
    solid = ~space
    glued = np.zeros(len(s), bool)
    glued[1:] = solid[1:] & space[:-1] & ends_blank[:-1] & ~text_end[s[1:]]
    cut[s[solid] - glued[solid]] = True

    marks = np.flatnonzero((k == OTHER) & (e - s == 1) & (points[s] == 39) & ~glued & ~closed)
    marks = marks[k[np.minimum(marks + 1, len(k) - 1)] == LETTER]
    for run in marks.tolist():
        a, b = int(e[run]), int(e[run + 1])
        tail = joined[a:min(a + 2, b)]
        hit = next((x for x in SUFFIXES if tail.startswith(x)), None)
        if hit:
            cut[a] = False
            if a + len(hit) < b:
                cut[a + len(hit)] = True
    starts = np.flatnonzero(cut[:n])
    ends = np.append(starts[1:], n)
    return joined, starts, ends, np.searchsorted(starts, bounds)


def piece_hashes(joined: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit content hash of each piece."""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    powers = np.full(len(points), _ODD, np.uint64)
    inverse = np.full(len(points) + 1, _INV, np.uint64)
    if len(points):
        powers[0] = 1
    inverse[0] = 1
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_tables()[1][points] * np.cumprod(powers), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * np.cumprod(inverse)[starts] + (ends - starts).astype(np.uint64) * _MUL)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every (start, length) run, one after the other."""
    lengths = lengths.astype(np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64) - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


class PieceCache:
    """Ids of pieces seen by this task. A cache alone: it is emptied when full and never changes a result."""

    def __init__(self, encode, limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used, self.count = np.empty(1 << 16, np.uint32), 0, 0

    def _add(self, hashes: list[int], ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        values = np.fromiter((x for row in ids for x in row), np.uint32, int(sizes.sum()))
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used:self.used + len(values)] = values
        if self.count + len(ids) > len(self.begin):
            grow = np.zeros(max(len(self.begin), len(ids)), np.int64)
            self.begin, self.size = np.concatenate([self.begin, grow]), np.concatenate([self.size, grow])
        self.begin[self.count:self.count + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count:self.count + len(ids)] = sizes
        self.slot.update(zip(hashes, range(self.count, self.count + len(ids)), strict=True))
        self.used, self.count = self.used + len(values), self.count + len(ids)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and per text the offset of its first id (one more at the end)."""
        joined, starts, ends, first = split(texts)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        distinct, at, which = np.unique(piece_hashes(joined, starts, ends), return_index=True, return_inverse=True)
        if self.count > self.limit:
            self.clear()
        keys = distinct.tolist()
        missing = [i for i, h in enumerate(keys) if h not in self.slot]
        if missing:
            spans = [(int(starts[at[i]]), int(ends[at[i]])) for i in missing]
            self._add([keys[i] for i in missing], self.encode([joined[a:b] for a, b in spans]))
        slots = np.fromiter(map(self.slot.__getitem__, keys), np.int64, len(keys))[which]
        sizes = self.size[slots]
        before = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        return self.flat[ragged(self.begin[slots], sizes)], before[first]
