"""Vectorised text helpers used inside tasks: bytes, words, hashes.

All functions take the flat UTF-8 bytes of many texts plus row offsets, so
one numpy pass serves a whole Arrow batch. Nothing here keeps state between
batches, and no hash depends on the neighbours of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text handled by one numpy pass; a longer single text is one pass of its own.
CHUNK_BYTES = 1 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The word separators \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII punctuation and control bytes, for matching that ignores them.
PUNCT = np.array([c < 128 and not chr(c).isalnum() for c in range(256)]) & ~SPACE


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat UTF-8 bytes and row offsets (len + 1) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0 or column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (first, last) whose texts hold about `limit` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; `span_hash` reads any substring's hash from them."""
    powers = np.full(len(data), _ODD, np.uint64)
    if len(powers):
        powers[0] = 1
    np.cumprod(powers, out=powers)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers, out=out[1:])
    return out


def inverse_powers(n: int) -> np.ndarray:
    out = np.full(n, _INV, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hashes of the byte spans [start, end)."""
    inverse = inverse_powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MUL)


def word_hashes(data: np.ndarray, offsets: np.ndarray, strip: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and per row the offset of its first word.

    A word is a run of bytes other than \\x20 and \\x09-\\x0D, with A-Z
    lower-cased; `strip` also drops ASCII punctuation inside words (a word of
    punctuation alone vanishes).
    """
    data = LOWER[data]
    if strip:
        keep = ~PUNCT[data]
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        data, offsets = data[keep], kept[offsets]
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] |= solid[first]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] |= solid[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return span_hash(prefix_hash(data), starts, stops), np.searchsorted(starts, offsets)


def combine(words: np.ndarray, positions) -> np.ndarray:
    """For each window start, one hash of the words at the given offsets."""
    n = len(words) - max(positions)
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, p in enumerate(positions):
        out = out * _ODD + words[p:p + n] + np.uint64(k)
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word shingles.

    Fewer words than `width`: the whole sequence is the one shingle. No words:
    an empty set.
    """
    words, first = word_hashes(data, offsets)
    rolled = combine(words, range(width))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            out.append(np.array([combine(words[a:b], range(b - a))[0] + np.uint64(b - a)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out
