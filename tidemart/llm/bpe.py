"""Byte-level BPE by folds in Spark higher-order functions (operator 9).

A word is a set of places between its bytes at which pieces meet, at first all
of them. The fold goes once over the pieces of the vocabulary that occur in the
word, lowest rank first, then leftmost, and takes away the place inside each
that is just two pieces at that moment. One pass does what merging the lowest
pair again and again does, as long as a pair of lower rank never comes up late.
Were piece d to come up after a merge of higher rank inside it, the merges
ranked below d would leave d's own bytes in three pieces or more: no piece of a
trained vocabulary is so, and `_Words.odd` names those that are. A word that
holds one of them, or of more than MASK_BYTES, is an array of piece ids
instead, at first one for each byte; its fold merges, again and again, the
adjacent pair of lowest rank, the leftmost first, until no pair has a rank;
ranks come from a map of two arrays, a table of one row that a task builds and
the join broadcasts.

Words are folded once, not once an occurrence: the words that occur most in the
whole table are counted, folded and sent to all tasks (at most DICTIONARY of
them, so their size is bounded), and a chunk of documents folds its other
distinct words, in rows of at most ROW_WORDS. A word of more than MASK_BYTES is
cut where no piece of the vocabulary that occurs in it spans the cut: merges
never cross such a place. Decoding looks ids up in an array of binary pieces
and concatenates them.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import pretokens
from .common import written
from .kernels import _MUL, chunks, mix, text_column

#: Of the rank map: slots, displacement classes, multipliers (products stay below 2**63), bits of a rank.
SLOT_BITS, CLASS_BITS, RANK_BITS = 18, 15, 17
SLOT_MUL, CLASS_MUL = 1_540_483_477, 1_103_515_245
#: Rank of a pair that does not merge; the id that stands at both ends of a word while it is folded.
NEVER, EDGE = (1 << 31) - 1, (1 << 16) - 1
#: Characters of one chunk of documents, whose distinct words are folded together, and of one numpy pass.
CHUNK_CHARS, SPLIT_CHARS = 4 << 20, 1 << 18
#: Words folded ahead for the whole table, their longest, and how often a word of a chunk occurs there to be counted.
DICTIONARY, DICTIONARY_CHARS, COUNTED = 1 << 19, 64, 2
#: Words in one row, and bytes of a word whose places fit one half of a long.
ROW_WORDS, MASK_BYTES = 4096, 30


def read_ranks(path: str) -> dict[bytes, int]:
    """Piece -> rank from a file of base64 pieces and ranks, one pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """left id * 65536 + right id -> id of the merged piece, for every pair of pieces that joins to a piece."""
    if max(ranks.values()) >= 1 << 16:
        raise ValueError("ids must be below 65536")
    out = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                out[left << 16 | right] = rank
    return out


def _slot(key, shift):
    return ((key * SLOT_MUL >> 24) + shift) % (1 << SLOT_BITS)


def rank_map(pairs: dict[int, int]) -> tuple[list[int], list[int]]:
    """A collision-free hash map as two arrays: a shift for each class of keys, and key << RANK_BITS | rank in each slot."""
    classes: dict[int, list[int]] = {}
    for key in pairs:
        classes.setdefault((key * CLASS_MUL >> 28) % (1 << CLASS_BITS), []).append(key)
    shifts, slots = [0] * (1 << CLASS_BITS), [-1] * (1 << SLOT_BITS)
    for c, keys in sorted(classes.items(), key=lambda x: -len(x[1])):
        for shift in range(1 << SLOT_BITS):
            at = [_slot(k, shift * 7919) for k in keys]
            if len(set(at)) == len(at) and all(slots[i] < 0 for i in at):
                break
        else:
            raise ValueError("no room in the rank map")
        shifts[c] = shift * 7919 % (1 << SLOT_BITS)
        for i, k in zip(at, keys, strict=True):
            slots[i] = k << RANK_BITS | pairs[k]
    return shifts, slots


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rank_table(spark: SparkSession, vocabulary: str) -> DataFrame:
    """The rank map of a file as one row, built once by a task: neither the driver nor a plan holds it."""
    def build(batches):
        for _ in batches:
            shifts, slots = rank_map(pair_ranks(read_ranks(vocabulary)))
            yield pa.RecordBatch.from_arrays([pa.array([shifts], pa.list_(pa.int32())), pa.array([slots], pa.list_(pa.int64()))], ["shifts", "slots"])

    return written(spark.range(0, 1, 1, 1).mapInArrow(build, "shifts array<int>, slots array<long>"), "bpe-ranks")


def fold_word(parts: Column, shift_of: Column, slot_of: Column) -> Column:
    """Ids after all merges of a word given as ids (array<int>): lowest rank first, then leftmost."""
    never, edge = F.lit(NEVER), F.array(F.lit(EDGE))

    def rank(left: Column, right: Column) -> Column:
        """The pair's rank, which is the merged piece's id; `never` if it does not merge."""
        key = F.shiftleft(left.cast("long"), 16).bitwiseOR(right.cast("long"))
        return let(key, lambda k: let(
            F.get(slot_of, (F.shiftright(k * F.lit(SLOT_MUL), 24) + F.get(
                shift_of, F.shiftright(k * F.lit(CLASS_MUL), 28).bitwiseAND(F.lit((1 << CLASS_BITS) - 1)).cast("int")))
                .bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int")),
            lambda e: F.when(F.shiftright(e, RANK_BITS) == k, e.bitwiseAND(F.lit((1 << RANK_BITS) - 1)).cast("int")).otherwise(never)))

    def merge(state: Column, _) -> Column:
        p, k = state["p"], state["k"]
        return let(F.array_min(k), lambda low: F.when(low == never, state).otherwise(
            let(F.array_position(k, low).cast("int"), lambda i: F.struct(  # the pair is p[i - 1], p[i], counted from 0
                F.concat(F.slice(p, F.lit(1), i - 1), F.array(low), F.slice(p, i + 2, F.size(p))).alias("p"),
                F.concat(F.slice(k, F.lit(1), i - 2), F.array(rank(F.get(p, i - 2), low), rank(low, F.get(p, i + 1))),
                         F.slice(k, i + 2, F.size(k))).alias("k")))))

    def fold(p: Column) -> Column:
        first = F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), rank)
        return F.aggregate(F.slice(p, F.lit(4), F.size(p)), F.struct(p.alias("p"), first.alias("k")), merge,
                           lambda s: F.slice(s["p"], F.lit(2), F.size(s["p"]) - 2))

    return F.when(F.size(parts) < 2, parts).otherwise(let(F.concat(edge, parts, edge), fold))


def fold_places(steps: Column) -> Column:
    """The places (bits) at which pieces meet after all merges of a word given by its steps (array<long>), in order.

    A step is a piece that occurs: all its places in the high half, its two ends in the low half.
    """
    def merge(places: Column, step: Column) -> Column:
        inside = places.bitwiseAND(F.shiftright(step, 32)).bitwiseXOR(step.bitwiseAND(F.lit((1 << 32) - 1)))
        return F.when(F.bit_count(inside) == 1, places.bitwiseAND(F.bitwise_not(inside))).otherwise(places)

    return F.aggregate(steps, F.lit((1 << MASK_BYTES + 1) - 1).cast("long"), merge)


class Folded(NamedTuple):
    """Ids of words folded ahead, by ascending word hash: ids of word i are flat[edges[i]:edges[i + 1]]."""

    hashes: np.ndarray
    edges: np.ndarray
    flat: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's place, -1 where it is not there."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


#: Words of a row: bytes of the words given as steps, bytes of each (0 for the others), ids of bytes of the others, steps.
UNFOLDED = "text binary, sizes binary, words array<array<int>>, steps array<array<long>>"


def _grown(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte strings with one byte more."""
    return mix(hashes * _MUL + last + np.uint64(1))


def _byte_hashes(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit content hash of each byte string text[start:start + size]; notes in `begins` how they begin."""
    out = np.zeros(len(starts), np.uint64)
    for n in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > n)
        out[at] = _grown(out[at], text[starts[at] + n])
        if begins is not None:
            begins[out[at] >> np.uint64(44)] = True
    return out


class _Words:
    """What a task needs to turn distinct words into first pieces: ids of bytes and of whole words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        known = []
        for piece, rank in ranks.items():
            try:
                known.append((piece.decode("utf-8"), rank))
            except UnicodeDecodeError:
                continue  # no text has this piece as a whole word
        lengths = np.cumsum([0, *(len(p) for p, _ in known)])
        hashes = pretokens.piece_hashes("".join(p for p, _ in known), lengths[:-1], lengths[1:])
        order = np.argsort(hashes)
        self.whole = Folded(hashes[order], np.arange(len(known) + 1), np.array([r for _, r in known], np.int32)[order])
        self.ranks = ranks
        sizes = np.array([*map(len, ranks)], np.int64)
        self.begins = np.zeros(1 << 20, bool)  # by the first bits of a hash: whether a piece may begin so
        hashes = _byte_hashes(np.frombuffer(b"".join(ranks), np.uint8), np.cumsum(sizes) - sizes, sizes, self.begins)
        order = np.argsort(hashes)
        self.pieces = Folded(hashes[order], np.arange(len(ranks) + 1), np.array(list(ranks.values()), np.int64)[order])

    def occurring(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, id, step) of the pieces of two bytes and more in words of at most MASK_BYTES, by word, rank and place."""
        sizes = np.diff(offsets)
        sizes = np.where(sizes <= MASK_BYTES, sizes, 0)
        word = np.repeat(np.arange(len(sizes)), sizes)
        at = pretokens.ragged(offsets[:-1], sizes)
        left = offsets[word + 1] - at
        hashes, found = np.zeros(len(at), np.uint64), [np.empty(0, np.int64)]
        for size in range(1, MASK_BYTES + 1):  # only strings with which a piece begins grow on
            hashes = _grown(hashes, text[at + size - 1])
            own = self.pieces.find(hashes) if size > 1 else np.full(len(at), -1)
            hit = np.flatnonzero(own >= 0)
            start = at[hit] - offsets[word[hit]]
            found.append((word[hit] << 26) | (self.pieces.flat[own[hit]] << 10) | (start << 5) | (start + size))
            on = np.flatnonzero(self.begins[hashes >> np.uint64(44)] & (left > size))
            if not len(on):
                break
            hashes, at, left, word = hashes[on], at[on], left[on], word[on]
        keys = np.sort(np.concatenate(found))
        one, start, end = np.int64(1), keys >> 5 & 31, keys & 31
        return keys >> 26, keys >> 10 & 0xFFFF, ((one << end + 1) - (one << start) << 32) | (one << start) | (one << end)

    @functools.cached_property
    def odd(self) -> np.ndarray:
        """By id: one pass over the merges ranked below the piece does not leave its bytes in two pieces, so that it
        (or an odd piece inside) may come up late."""
        pieces = [p for p in self.ranks if 2 <= len(p) <= MASK_BYTES]
        own = np.array([self.ranks[p] for p in pieces], np.int64)
        lengths = np.array([len(p) for p in pieces], np.int64)
        word, ids, steps = self.occurring(np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum(lengths)]))
        below = ids < own[word]
        word, steps = word[below], steps[below]
        first = np.searchsorted(word, np.arange(len(pieces) + 1))
        places = (np.int64(1) << lengths + 1) - 1
        for k in range(int(np.diff(first).max(initial=0))):
            at = np.flatnonzero(np.diff(first) > k)
            step = steps[first[at] + k]
            inside = (places[at] & step >> 32) ^ (step & (1 << 32) - 1)
            places[at] &= np.where(np.bitwise_count(inside) == 1, ~inside, -1)
        out = np.zeros(max(self.ranks.values()) + 1, bool)
        out[own[np.bitwise_count(places) != 3]] = True
        return out

    def unfolded(self, text: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        """A row of UNFOLDED: the words as steps, and the bytes of those; empty lists and no bytes for the others, given as ids of bytes."""
        word, ids, steps = self.occurring(text, offsets)
        sizes, count = np.diff(offsets), len(offsets) - 1
        plain = sizes > MASK_BYTES
        plain[word[self.odd[ids]]] = True
        steps = steps[~plain[word]]
        edges = np.concatenate([[0], np.cumsum(np.where(plain, 0, np.bincount(word, minlength=count)))])
        part = np.where(plain, sizes, 0)
        bytes_of = text[pretokens.ragged(offsets[:-1], sizes - part)]
        words = _lists(self.byte_ids[text[pretokens.ragged(offsets[:-1], part)]], np.concatenate([[0], np.cumsum(part)]))
        steps = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(steps, pa.int64()))
        return [pa.array([x.tobytes()], pa.binary()) for x in (bytes_of, (sizes - part).astype(np.int32))] + [
            pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), x) for x in (words, steps)]

    def folded(self, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids of each) of a row of UNFOLDED whose words are folded."""
        text, sizes = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("text", np.uint8), ("sizes", np.int32)))
        words, places = (batch.column(c).slice(i, 1).flatten() for c in ("words", "places"))
        word = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(text)) - np.repeat(np.cumsum(sizes, dtype=np.int64) - sizes, sizes)
        starts = np.flatnonzero(places.to_numpy()[word] >> place & 1)
        ids = self.pieces.flat[self.pieces.find(_byte_hashes(text, starts, np.diff(starts, append=len(text))))]
        parts, merged = np.bincount(word[starts], minlength=len(sizes)), np.diff(words.offsets.to_numpy())
        begin = np.cumsum(parts + merged) - parts - merged  # one of the two is 0
        flat = np.empty(len(ids) + int(merged.sum()), np.int32)
        flat[pretokens.ragged(begin, parts)] = ids
        flat[pretokens.ragged(begin, merged)] = words.flatten().to_numpy()
        return flat, parts + merged

    @functools.cached_property
    def by_length(self) -> dict[int, set[bytes]]:
        out: dict[int, set[bytes]] = {}
        for piece in self.ranks:
            out.setdefault(len(piece), set()).add(piece)
        return out

    def cuts(self, word: bytes) -> list[int]:
        """Offsets at which no piece that occurs in the word spans the place before them."""
        spanned = np.zeros(len(word) + 1, np.int32)
        for size, pieces in self.by_length.items():
            if size > 1:
                for i in [i for i in range(len(word) - size + 1) if word[i:i + size] in pieces]:
                    spanned[i + 1] += 1
                    spanned[i + size] -= 1
        return (np.flatnonzero(np.cumsum(spanned)[1:-1] == 0) + 1).tolist()

    def bytes_of(self, joined: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all bytes of the words, offsets of the words in them)."""
        text = np.frombuffer(joined.encode(), np.uint8)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        width = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=width[1:])
        sizes = width[ends] - width[starts]
        offsets = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        return text[pretokens.ragged(width[starts], sizes)], offsets


@functools.cache
def _words(path: str) -> _Words:
    return _Words(read_ranks(path))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def _fold_rows(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """The rows with their `words` folded to ids and their `steps` to `places`; each row meets the rank map, so it has many words."""
    folded = let(F.col("shifts"), lambda shift_of: let(F.col("slots"), lambda slot_of: F.transform(  # read from the row once
        "words", lambda w: fold_word(w, shift_of, slot_of)))).alias("words")
    places = F.transform("steps", fold_places).alias("places")
    return rows.crossJoin(F.broadcast(ranks)).select(*[{"words": folded, "steps": places}.get(c, c) for c in rows.columns])


def frequent_words(docs: DataFrame, vocabulary: str, text: str = "text", ranks: DataFrame | None = None) -> Folded:
    """The words that occur most in all documents, folded: at most DICTIONARY, whatever the size of the table.

    A chunk counts words it holds at least COUNTED times; the counts are added
    up, and the words above the count that DICTIONARY of them reach are folded
    by one job. Which words these are changes the work, never an id.
    """
    def count(batches):
        table = _words(vocabulary)
        for batch in batches:
            for chunk in _chunks(batch.column(0), CHUNK_CHARS):
                held: dict[int, str] = {}
                hashes, counts = [], []
                for _, texts in _pieces(batch.column(0), *chunk):
                    joined, starts, ends, _ = pretokens.split(texts)
                    own, at, n = np.unique(pretokens.piece_hashes(joined, starts, ends), return_index=True, return_counts=True)
                    wanted = (table.whole.find(own) < 0) & (ends[at] - starts[at] <= DICTIONARY_CHARS)
                    for h, i in zip(own[wanted].tolist(), at[wanted].tolist(), strict=True):
                        held.setdefault(h, joined[starts[i]:ends[i]])
                    hashes.append(own[wanted])
                    counts.append(n[wanted])
                own, which = np.unique(np.concatenate(hashes), return_inverse=True)
                n = np.bincount(which, np.concatenate(counts), len(own)).astype(np.int64)
                often = n >= COUNTED
                yield pa.RecordBatch.from_arrays([pa.array([held[h] for h in own[often].tolist()], pa.string()), pa.array(n[often])], ["word", "n"])

    counted = written(docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
    held, least = 0, 0
    for row in counted.groupBy(F.least("n", F.lit(10_000)).alias("n")).count().orderBy(F.desc("n")).collect():  # at most 10,000 rows
        held += row["count"]
        if held > DICTIONARY:
            break
        least = row["n"]
    if not least:
        return Folded(np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint16))

    def split(batches):
        table = _words(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROW_WORDS):
                words = batch.column(0).slice(lo, ROW_WORDS).to_pylist()
                ends = np.cumsum([len(w) for w in words])
                starts = ends - [len(w) for w in words]
                hashes = pretokens.piece_hashes("".join(words), starts, ends)
                yield pa.RecordBatch.from_arrays([pa.array([hashes.tobytes()], pa.binary()), *table.unfolded(*table.bytes_of("".join(words), starts, ends))],
                                                 ["hashes", "text", "sizes", "words", "steps"])

    def pack(batches):
        table = _words(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                flat, sizes = table.folded(batch, i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()) for x in (batch.column(0)[i].as_py(), sizes.astype(np.int16).tobytes(), flat.astype(np.uint16).tobytes())],
                    ["hashes", "sizes", "flat"])

    tasks = 4 * docs.sparkSession.sparkContext.defaultParallelism
    chosen = written(counted.filter(F.col("n") >= least).select("word").repartition(tasks), "bpe-frequent")
    firsts = chosen.mapInArrow(split, f"hashes binary, {UNFOLDED}")
    folded = _fold_rows(firsts, rank_table(docs.sparkSession, vocabulary) if ranks is None else ranks)
    packed = folded.mapInArrow(pack, "hashes binary, sizes binary, flat binary").collect()  # at most DICTIONARY words
    hashes, sizes, flat = (np.concatenate([np.frombuffer(r[c], t) for r in packed]) for c, t in
                           (("hashes", np.uint64), ("sizes", np.int16), ("flat", np.uint16)))
    order = np.argsort(hashes)
    sizes, begin = sizes.astype(np.int64), np.cumsum(sizes, dtype=np.int64) - sizes
    edges = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes[order], out=edges[1:])
    return Folded(hashes[order], edges, flat[pretokens.ragged(begin[order], sizes[order])])


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", decoded: str | None = None) -> DataFrame:
    """(key, ids) of every row: the BPE ids (array<int>) of its whole text by the rank file `vocabulary`.
    With a name in `decoded`, also the ids decoded again (as `decode` does, by the task that has them).

    Each match of the pre-tokenising pattern is encoded separately, without
    special tokens; null and empty texts have no ids. A task splits a chunk
    of documents into words; words of the vocabulary and frequent words have
    their ids already, the fold runs over the chunk's other distinct words,
    and the ids are put in place of the words. Rows of words go before the
    row of their chunk through the same task: no state leaves it, and a lost
    task is simply run again.
    """
    ranks = rank_table(docs.sparkSession, vocabulary)
    ahead = docs.sparkSession.sparkContext.broadcast(tuple(frequent_words(docs, vocabulary, text, ranks)))
    kind = docs.schema[key].dataType.simpleString()
    key_type = to_arrow_type(docs.schema[key].dataType)
    names = ["keys", "first", "codes", "parts", "text", "sizes", "words", "steps"]
    none = [pa.nulls(1, t) for t in (pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int64())))]

    def row(keys, first, codes, parts, words) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.list_(key_type)) if keys is None else pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
             pa.array([first], pa.binary()), pa.array([codes], pa.binary()), pa.array([parts], pa.binary()), *(words or none)], names)

    def words(batches):
        table, dictionary = _words(vocabulary), Folded(*ahead.value)
        for batch in batches:
            ids = batch.column(0)
            for a, b in _chunks(batch.column(1), CHUNK_CHARS):
                hashes, codes, counts, held = [], [], [], 0
                rare: dict[int, tuple[str, int, int]] = {}
                for _, texts in _pieces(batch.column(1), a, b):  # numpy holds this much text at a time
                    joined, starts, ends, first = pretokens.split(texts)
                    own, at, which = np.unique(pretokens.piece_hashes(joined, starts, ends), return_index=True, return_inverse=True)
                    unknown = np.flatnonzero((table.whole.find(own) < 0) & (dictionary.find(own) < 0))
                    for i in unknown.tolist():
                        rare.setdefault(int(own[i]), joined[starts[at[i]]:ends[at[i]]])
                    hashes.append(own)
                    codes.append((which + held).astype(np.int32))
                    counts.append(np.diff(first))
                    held += len(own)
                distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
                # codes: whole words, then words of the dictionary, then the chunk's own in ascending hash order
                place, known = table.whole.find(distinct), dictionary.find(distinct)
                mine = (place < 0) & (known < 0)
                order = distinct[mine].tolist()
                for lo in range(0, len(order), ROW_WORDS):
                    (flat, parts), offsets = _cut(table, [rare[h] for h in order[lo:lo + ROW_WORDS]])
                    yield row(None, None, None, parts, table.unfolded(flat, offsets))
                code = np.where(place >= 0, place, np.where(known >= 0, len(table.whole.hashes) + known, 0)).astype(np.int32)
                code[mine] = len(table.whole.hashes) + len(dictionary.hashes) + np.arange(len(order))
                first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
                yield row(ids.slice(a, b - a), first.astype(np.int32).tobytes(), code[which.astype(np.int32)[np.concatenate(codes)]].tobytes(), None, None)

    chunks = docs.select(key, text).mapInArrow(words, f"keys array<{kind}>, first binary, codes binary, parts binary, {UNFOLDED}")
    folded = _fold_rows(chunks, ranks)

    def assemble(batches):
        table, dictionary = _words(vocabulary), Folded(*ahead.value)
        base = len(table.whole.hashes) + len(dictionary.hashes)
        # ids of whole words and of the dictionary in one flat array, then those of the chunk
        shared = np.concatenate([table.whole.flat, dictionary.flat.astype(np.int32)])
        sizes = np.concatenate([np.ones(len(table.whole.hashes), np.int64), np.diff(dictionary.edges)])
        begin = np.cumsum(sizes) - sizes
        own_flat, own_sizes = [], []
        pieces_of = _Pieces(table.ranks) if decoded else None
        for batch in batches:
            for i in range(batch.num_rows):
                if not batch.column(0)[i].is_valid:
                    ids, parts = table.folded(batch, i)
                    own_flat.append(ids)
                    own_sizes.append(_joined_sizes(parts, np.frombuffer(batch.column(3)[i].as_py(), np.int32)))
                    continue
                keys = batch.column(0).slice(i, 1).flatten()
                first, codes = (np.frombuffer(batch.column(c)[i].as_py(), np.int32) for c in (1, 2))
                flat = np.concatenate([shared, *own_flat])
                size = np.concatenate([sizes, *own_sizes])
                start = np.concatenate([begin, len(shared) + np.cumsum(size[base:]) - size[base:]])
                own_flat, own_sizes = [], []
                for lo in range(0, len(keys), 512):
                    hi = min(lo + 512, len(keys))
                    own = codes[first[lo]:first[hi]]
                    before = np.zeros(len(own) + 1, np.int64)
                    np.cumsum(size[own], out=before[1:])
                    ids = flat[pretokens.ragged(start[own], size[own])]
                    lists = _lists(ids, before[first[lo:hi + 1] - first[lo]])
                    out = [keys.slice(lo, hi - lo), lists] + ([pieces_of.join(lists)] if decoded else [])
                    yield pa.RecordBatch.from_arrays(out, [key, "ids", decoded][:len(out)])

    return folded.mapInArrow(assemble, f"{key} {kind}, ids array<int>" + (f", {decoded} binary" if decoded else ""))


def _cut(table: _Words, words: list[str]) -> tuple[tuple[np.ndarray, bytes], np.ndarray]:
    """((bytes of the words, parts of each word as int32 bytes), offsets of the parts): a long word has several parts."""
    raw = [w.encode() for w in words]
    offsets, parts, held = [0], [], 0
    for w in raw:
        cuts = table.cuts(w) if len(w) > MASK_BYTES else []
        offsets += [held + c for c in cuts] + [held + len(w)]
        parts.append(len(cuts) + 1)
        held += len(w)
    return (np.frombuffer(b"".join(raw), np.uint8), np.array(parts, np.int32).tobytes()), np.array(offsets, np.int64)


def _joined_sizes(sizes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Ids of each word from the ids of its parts."""
    ends = np.cumsum(parts)
    before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return before[ends] - before[ends - parts]


def _chunks(texts: pa.Array, limit: int):
    """Row ranges (first, last) whose texts hold about `limit` characters (bytes) together; a longer text is a range of its own."""
    _, offsets = text_column(texts)
    return chunks(offsets, limit)


def _pieces(texts: pa.Array, first: int, last: int):
    """((first, last), texts) of parts of some rows, SPLIT_CHARS each; null reads as empty."""
    for lo, hi in _chunks(texts.slice(first, last - first), SPLIT_CHARS):
        yield (first + lo, first + hi), [t or "" for t in texts.slice(first + lo, hi - lo).to_pylist()]


class _Pieces:
    """The vocabulary's pieces by id, to be joined."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.begin, self.flat = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, column: pa.Array) -> pa.Array:
        """The bytes of each list of ids; null for null."""
        own = column.flatten().to_numpy()
        offsets = np.zeros(len(own) + 1, np.int64)
        np.cumsum(self.sizes[own], out=offsets[1:])
        counts = np.cumsum([0, *(n or 0 for n in pa.compute.list_value_length(column).to_pylist())])
        text = self.flat[pretokens.ragged(self.begin[own], self.sizes[own])].tobytes()
        edges = offsets[counts].tolist()
        null = column.is_null().to_pylist()
        return pa.array([None if n else text[x:y] for n, x, y in zip(null, edges[:-1], edges[1:], strict=True)], pa.binary())


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns plus the ids' pieces concatenated (binary); null ids decode to null, no ids to no bytes."""
    keep = [c for c in rows.columns if c != name]
    place = keep.index(ids)

    def run(batches):
        pieces = _Pieces(read_ranks(vocabulary))
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, pieces.join(part.column(place))], [*keep, name])

    return rows.select(*keep).mapInArrow(run, rows.select(*keep).schema.add(name, "binary"))
