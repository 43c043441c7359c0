"""Benchmark decontamination by spaced seeds (operator 2).

A seed is a fixed mask over a span of words; the words at its set positions
are hashed and the others ignored, so one hash survives substitutions at the
ignored positions. Hashes of every benchmark window are joined with those of
every document window; each hit names a diagonal (document position minus
item position), and the overlap around it is verified word by word.

An overlap that is accepted has a positive score from either end, so the last
ten words of a longer one differ in at most one word, the fifth to ninth from
its end (or the last nine are equal): SEEDS has a mask for each case. An item
too short for MIN_WORDS / MIN_SHARE words may differ in a few words anywhere;
it is cut into five blocks, and masks leave out as many blocks as words may
differ. So every accepted overlap has a seed hit.

A bitmap of fixed size over the benchmark's hashes is sent to all tasks, so
that only document windows that may hit become rows; its size does not depend
on either table, and the join after it is exact.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .kernels import chunks, combine, text_column, word_hashes

#: Fixed masks for items of at least LONG words (1: the word counts, 0: it is ignored).
SEEDS = ("111111111", "1111011111", "1110111111", "1101111111", "1011111111")
BITMAP_BITS = 26
#: A verified overlap has at least this many equal words (or 0.8 of a shorter item) and 0.8 equal words.
MIN_WORDS = 13
MIN_SHARE = 0.8
#: Items with fewer words must be equal as a whole.
SHORTEST = 5
#: Items of at least so many words must share MIN_WORDS.
LONG = 16
BLOCKS = 5


def words_needed(length: int) -> int:
    """Equal words that an overlap with an item of so many words needs."""
    return min(MIN_WORDS, int(np.ceil(MIN_SHARE * length)))


def item_seeds(length: int) -> list[tuple[tuple[int, ...], int, bool]]:
    """(set positions from the first one, the first one's place, whole) of each seed of an item of so many words.

    The seeds of items of LONG words slide over the item (place 0 is then any
    window); those of shorter items stand at their place. `whole` marks an
    item that must be equal word by word.
    """
    if length >= LONG:
        return [(tuple(i for i, c in enumerate(s) if c == "1"), 0, False) for s in SEEDS]
    if length < SHORTEST:
        return [(tuple(range(length)), 0, True)]
    blocks = np.array_split(np.arange(length), BLOCKS)
    out = []
    for kept in combinations(blocks, BLOCKS - (length - words_needed(length))):
        at = np.concatenate(kept).tolist()
        out.append((tuple(i - at[0] for i in at), at[0], False))
    return out


def seed_numbers() -> dict[tuple[tuple[int, ...], bool], int]:
    """A number for each different seed; equal masks of several lengths are one seed."""
    every = {(positions, whole): None for n in range(LONG, 0, -1) for positions, _, whole in item_seeds(n)}
    return {seed: i for i, seed in enumerate(every)}


def best_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(equal words, first, last) of the best stretch along a diagonal, in item positions.

    A stretch scores +1 for an equal word and -4 for another, so a positive
    one has more than 0.8 equal words. None if the overlap is too short. An
    item of fewer than LONG words may also have its 0.8 equal words anywhere:
    the stretch is then from its first to its last equal word.
    """
    a, b = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if b <= a:
        return None
    equal = doc[a + diagonal:b + diagonal] == item[a:b]
    running = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    gain = running - np.minimum.accumulate(running)
    last = int(gain.argmax())
    first = int(running[:last + 1].argmin()) if last else 0
    matched = int(equal[first:last].sum())
    need = words_needed(len(item))
    if matched >= need:
        return matched, a + first, a + last
    if len(item) < LONG and equal.sum() >= need:
        at = np.flatnonzero(equal)
        return len(at), a + int(at[0]), a + int(at[-1]) + 1
    return None


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(hash, item_id, item_pos, words) of every seed window of every item with words; an item's first row has its words."""
    numbers = seed_numbers()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_column(batch.column(1))
            words, first = word_hashes(data, offsets, strip=True)
            for i, key in enumerate(ids):
                own = words[first[i]:first[i + 1]]
                if not len(own):
                    continue
                hashes, at = [], []
                for positions, place, whole in item_seeds(len(own)):
                    found = combine(own, positions) + np.uint64(numbers[positions, whole])
                    places = np.arange(len(found)) if len(own) >= LONG else np.array([place])
                    hashes.append(found[places])
                    at.append(places)
                hashes, at = np.concatenate(hashes), np.concatenate(at)
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array([key] * n, pa.int64()), pa.array(at.astype(np.int32)),
                     pa.array([own.tobytes()] + [None] * (n - 1), pa.binary())], ["hash", "item_id", "item_pos", "words"])

    return benchmark.select(F.col(item_id).cast("long"), text).mapInArrow(run, "hash long, item_id long, item_pos int, words binary")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bit for each hash's top BITMAP_BITS bits, merged over tasks in slices of fixed size."""
    bits = BITMAP_BITS

    def mark(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            top = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            for part in np.unique(top >> np.uint64(16)).tolist():
                own = (top[top >> np.uint64(16) == part] & np.uint64(0xFFFF)).astype(np.int64)
                held.setdefault(part, np.zeros(1 << 16, bool))[own] = True
        for part, flags in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())],
                                             ["part", "bits"])

    out = np.zeros(1 << (bits - 3), np.uint8)
    # at most 2 ** (bits - 16) slices of 8 KB from each task that reads the benchmark; merged one at a time
    for row in hashes.select("hash").repartition(8).mapInArrow(mark, "part int, bits binary").toLocalIterator():
        out[row["part"] << 13:(row["part"] + 1) << 13] |= np.frombuffer(row["bits"], np.uint8)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that share a verified passage.

    Columns: doc_id, item_id, n_matched (equal words of the best overlap),
    n_words (words it spans), doc_pos and item_pos (its first word). Words are
    runs of non-space characters, lower-cased A-Z, without ASCII punctuation.
    Ties: the smallest doc_pos, then item_pos. Null or empty texts share
    nothing; rows with a null doc_id are reported with it; repeated doc_ids or
    item_ids give one row. Empty tables give no rows.
    """
    spark = docs.sparkSession
    windows = written(item_windows(benchmark), "benchmark-windows")
    shared = spark.sparkContext.broadcast(_bitmap(windows))
    items = windows.filter("words IS NOT NULL").select(F.col("item_id").alias("_item"), "words").distinct()
    lengths = [r["n"] for r in items.select(F.least(F.octet_length("words") / 8, F.lit(LONG)).cast("int").alias("n")).distinct().collect()]  # at most LONG values
    numbers = seed_numbers()
    used = sorted({(numbers[positions, whole], positions, whole) for n in lengths for positions, _, whole in item_seeds(n)})

    def hit(batches):
        table = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                words, first = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], strip=True)
                row_end = np.repeat(first[1:], np.diff(first))
                for s, positions, whole in used:
                    hashes = combine(words, positions) + np.uint64(s)
                    at = np.arange(len(hashes))
                    top = hashes >> np.uint64(64 - BITMAP_BITS)
                    live = (table[top >> np.uint64(3)] >> (7 - (top & np.uint64(7)).astype(np.uint8))) & 1
                    at = at[live.astype(bool) & (at + positions[-1] + 1 <= row_end[:len(at)])]
                    if whole and len(at):  # all hits of a whole item are alike: a document's first one stands for them
                        found = np.stack([np.searchsorted(first, at, "right").astype(np.uint64), hashes[at]])
                        at = at[np.sort(np.unique(found, axis=1, return_index=True)[1])]
                    if len(at):
                        row = np.searchsorted(first, at, "right") - 1
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(hashes[at].view(np.int64)), pa.array([ids[a + r] for r in row.tolist()], pa.int64()),
                             pa.array(at - first[row])], ["hash", "doc_id", "pos"])

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    hits = texts.mapInArrow(hit, "hash long, doc_id long, pos long")
    found = (hits.join(windows.select("hash", "item_id", "item_pos"), "hash")
             .select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    todo = (found.join(items, F.col("item_id").eqNullSafe(F.col("_item")))
            .groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set(F.struct("item_id", "diagonal", "words")).alias("todo")))
    pairs = texts.join(todo, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("doc_id", "text", "todo")

    def verify(batches):
        for batch in batches:
            ids, todos = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            data, offsets = text_column(batch.column(1))
            out = []
            for i, key in enumerate(ids):
                words, _ = word_hashes(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]), strip=True)
                for t in todos[i]:
                    if got := best_overlap(words, np.frombuffer(t["words"], np.uint64), t["diagonal"]):
                        out.append((key, t["item_id"], got[0], got[2] - got[1], got[1] + t["diagonal"], got[1]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)],
                                                 ["doc_id", "item_id", "n_matched", "n_words", "doc_pos", "item_pos"])

    verified = pairs.mapInArrow(verify, "doc_id long, item_id long, n_matched long, n_words long, doc_pos long, item_pos long")
    best = F.max(F.struct("n_matched", *((-F.col(c)).alias(c) for c in ("n_words", "doc_pos", "item_pos"))))
    return verified.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.n_matched", *((-F.col(f"b.{c}")).alias(c) for c in ("n_words", "doc_pos", "item_pos")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without those that share a verified passage with any item; a row with a null doc_id stays unless one leaks."""
    leaks = overlaps(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["_leak"]), "left_anti")
