"""Removal of repeated byte strings by suffix arrays (operator 7).

Every string of LENGTH bytes has an anchor: the GRAM-byte substring with the
least hash, the leftmost of equals. It depends on the string alone, so equal
strings have equal anchors at equal places, and only strings of one anchor
have to be compared. A document is cut into snippets, each the union of the
strings with one anchor position; a snippet whose anchor occurs nowhere else
holds no repeated string and is put aside. Equal snippets are one snippet
with a first place; all later places are repeats.

The distinct snippets of repeated anchors are dealt to shards by anchor. A
shard is refined into a suffix array (Larsson-Sadakane), common prefixes
follow from Kasai's inequality, and runs of suffixes with LENGTH bytes in
common are the equal strings. An anchor with more snippets than a shard holds
is split over several; their sorted string tables are then merged by binary
search.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .kernels import _BYTE, _ODD, chunks, mix, prefix_hash, span_hash, text_column

LENGTH = 100
GRAM = 32
#: Distinct snippets of one anchor in a shard, and bytes of the shards that one suffix array covers.
SHARD_SNIPPETS = 8192
ARRAY_BYTES = 3 << 19
_LAST = (1 << 63) - 1


# ---------------------------------------------------------------- anchors
def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start in row, length, anchor hash, snippet hash) of all snippets."""
    n = len(data)
    empty = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < LENGTH:
        return empty
    grams, width, power = _BYTE[data], 1, int(_ODD)
    while width < GRAM:
        grams = grams[:-width] * np.uint64(power) + grams[width:]
        width, power = width * 2, power * power % (1 << 64)
    grams = mix(grams)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, wanted = 1, LENGTH - GRAM + 1
    while span * 2 <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[:span - wanted], least[wanted - span:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # anchor of the string that starts here

    sizes = np.diff(offsets)
    rows = np.flatnonzero(sizes >= LENGTH)
    if not len(rows):
        return empty
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, offsets[rows], 1)
    np.add.at(inside, offsets[rows] + sizes[rows] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:len(at)]) > 0)
    row = np.searchsorted(offsets, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (at[starts[1:]] != at[starts[:-1]]) | (row[1:] != row[:-1])
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]
    owner = row[new]
    snippets = span_hash(prefix_hash(data), first, last + LENGTH)
    return owner, first - offsets[owner], last - first + LENGTH, grams[at[first]], snippets


def _occurrences(docs: DataFrame) -> DataFrame:
    """(anchor, snippet, doc, place) of every snippet; place = start * 1024 + length * 2 + 1 if the
    document has the snippet earlier itself (its anchor is then a hash of the place: it needs no partner)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                row, start, length, anchor, snippet = anchors(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                if not len(row):
                    continue
                own = mix(snippet ^ anchor) + mix(row.astype(np.uint64))
                again = np.ones(len(row), bool)
                again[np.unique(own, return_index=True)[1]] = False
                anchor = np.where(again, mix(own + start.astype(np.uint64)), anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(snippet.view(np.int64)), pa.array(ids[a + row]),
                     pa.array(start * 1024 + length * 2 + again)], ["anchor", "snippet", "doc", "place"])

    return docs.mapInArrow(run, "anchor long, snippet long, doc long, place long")


def _repeats(occurrences: DataFrame) -> DataFrame:
    """(anchor, snippet, doc, start, length, first): the snippets whose anchor occurs more than once, or
    that their document has earlier. `first`: no earlier place has the same snippet."""
    dealt = occurrences.repartition("anchor").sortWithinPartitions("anchor", "snippet", "doc", "place")

    def run(batches):
        held = None  # the last row, until the next one is known; then the first place of the run it is in
        before, lead = None, (0, 0)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = np.stack([batch.column(i).to_numpy() for i in range(4)])
                if held is not None:
                    rows = np.concatenate([held, rows], axis=1)
                if not rows.shape[1]:
                    continue
                now, held = rows[:, :-1], rows[:, -1:]
                after = held
            else:
                if held is None:
                    return
                now, after = held, None
            if not now.shape[1]:
                continue
            anchor, snippet, doc, place = now
            back = np.concatenate([before if before is not None else np.full((4, 1), 0), now[:, :-1]], axis=1)
            new_anchor, same = anchor != back[0], (anchor == back[0]) & (snippet == back[1])
            if before is None:
                new_anchor[0], same[0] = True, False
            ends = np.append(new_anchor[1:], after is None or after[0, 0] != anchor[-1])
            start_of = np.maximum.accumulate(np.where(same, -1, np.arange(len(anchor))))
            lead_doc = np.where(start_of < 0, lead[0], doc[np.maximum(start_of, 0)])
            lead_place = np.where(start_of < 0, lead[1], place[np.maximum(start_of, 0)])
            before, lead = now[:, -1:], (lead_doc[-1], lead_place[-1])
            again = place & 1 == 1
            first = (doc == lead_doc) & (place == lead_place) & ~again
            keep = again | ~(new_anchor & ends)
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep]) for x in (anchor, snippet, doc, (place >> 10), ((place & 1023) >> 1).astype(np.int32), first)],
                    ["anchor", "snippet", "doc", "start", "length", "first"])

    return dealt.mapInArrow(run, "anchor long, snippet long, doc long, start long, length int, first boolean")


# ---------------------------------------------------------- suffix arrays
def _packed(symbols: np.ndarray, n: int = 7) -> np.ndarray:
    """Seven 9-bit symbols from each position as one integer."""
    wide = np.concatenate([symbols.astype(np.int64), np.zeros(n, np.int64)])
    out = np.zeros(len(symbols), np.int64)
    for k in range(n):
        out = out << 9 | wide[k:k + len(symbols)]
    return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """All suffixes of a sequence of symbols (1 to 511) in ascending order, by Larsson-Sadakane refinement.

    Suffixes are sorted by seven symbols, then by twice as many in each round;
    a round sorts only the groups that are still larger than one.
    """
    n = len(symbols)
    key = _packed(symbols)
    order = np.argsort(key, kind="stable")
    starts = np.ones(n, bool)
    starts[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    depth = 7
    while True:
        rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
        single = starts.copy()
        single[:-1] &= starts[1:]
        slots = np.flatnonzero(~single)
        if not len(slots):
            return order
        own = order[slots]
        both = rank[own] * (n + 1) + rank[np.minimum(own + depth, n)] + 1
        by = np.argsort(both, kind="stable")
        order[slots] = own[by]
        both = both[by]
        starts[slots[1:]] |= both[1:] != both[:-1]
        depth *= 2


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Symbols that each suffix shares with the one before it in `order`.

    By Kasai's inequality a suffix shares at least one symbol less than the
    suffix one place to its left, and exactly that where the symbols left of
    both are equal; only the others are compared.
    """
    n = len(symbols)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    direct = np.ones(n, bool)
    inner = previous[1:] > 0
    direct[1:][inner] = symbols[:-1][inner] != symbols[previous[1:][inner] - 1]
    key = np.concatenate([_packed(symbols), np.zeros(1, np.int64)])
    shared = np.zeros(n, np.int64)
    at = np.flatnonzero(direct & (previous >= 0))
    a, b = at, previous[at]
    while len(at):
        difference = key[a] ^ key[b]
        equal = (difference == 0).astype(np.int64)
        for k in range(1, 7):
            equal += difference >> (9 * k) == 0
        equal = np.minimum(equal, n - np.maximum(a, b))
        shared[at] += equal
        more = (equal == 7) & (np.maximum(a, b) + 7 < n)
        at, a, b = at[more], a[more] + 7, b[more] + 7
    base = np.maximum.accumulate(np.where(direct, np.arange(n), 0))
    in_text = np.maximum(shared[base] - (np.arange(n) - base), 0)
    in_text[order[0]] = 0
    return in_text[order]


def equal_strings(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A class number for each start: equal where `length` bytes from there are equal.

    `data` holds bytes + 2 with a 1 after each snippet.
    """
    order = suffix_array(data)
    group = np.empty(len(data), np.int64)
    group[order] = np.cumsum(common_prefixes(data, order) < length)
    return group[starts]


def _later(group: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which members are not at their group's first (doc, place); equals of the first are not later."""
    by = np.lexsort((place, doc, group))
    g, d, p = group[by], doc[by], place[by]
    first = np.maximum.accumulate(np.where(np.append(True, g[1:] != g[:-1]), np.arange(len(g)), 0))
    out = np.empty(len(g), bool)
    out[by] = (d != d[first]) | (p != p[first])
    return out


def _spans(doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Strings of LENGTH bytes as joined (doc, begin, end) spans."""
    by = np.lexsort((place, doc))
    d, p = doc[by], place[by]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + LENGTH)
    last = np.append(np.flatnonzero(new)[1:], len(d)) - 1
    return pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(p[new]), pa.array(p[last] + LENGTH)], ["doc", "begin", "end"])


def _windows(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Bytes + 2 with separators, and the start, owner row and place in the document of each string."""
    texts = [np.frombuffer(r[4], np.uint8) for r in rows]
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.ones(int(sizes.sum()) + len(texts), np.int16)
    begin = np.cumsum(sizes + 1) - sizes - 1
    count = sizes - LENGTH + 1
    inside = np.ones(len(data), bool)
    inside[begin + sizes] = False
    data[inside] = np.concatenate(texts).astype(np.int16) + 2
    owner = np.repeat(np.arange(len(rows)), count)
    offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return data, begin[owner] + offset, owner, np.array([r[3] for r in rows], np.int64)[owner] + offset


def _sharded(snippets: DataFrame):
    """Rows (anchor, shard, shards, doc, start, text) -> spans to remove, and string tables of split anchors."""
    dealt = (snippets.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard")
             .select("anchor", "shard", "doc", "start", "text", "shards"))

    def blocks(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if held > ARRAY_BYTES and r[:2] != last:
                    yield rows
                    rows, held = [], 0
                rows.append(r)
                held, last = held + len(r[4]), r[:2]
        if rows:
            yield rows

    def run(batches):
        for rows in blocks(batches):
            data, starts, owner, place = _windows(rows)
            doc = np.array([r[2] for r in rows], np.int64)[owner]
            group = equal_strings(data, starts)
            later = _later(group, doc, place)
            split = np.array([r[5] > 1 for r in rows])[owner]
            if later.any():
                got = _spans(doc[later], place[later])
                yield _row(got, len(got))
            if (split & ~later).any():
                # the shard's table of distinct strings, each with its first place
                at = np.flatnonzero(split & ~later)
                text = (data - 2).astype(np.uint8)
                digest = span_hash(prefix_hash(text), starts[at], starts[at] + LENGTH).view(np.int64)
                anchor, parts = (np.array([r[k] for r in rows], np.int64)[owner][at] for k in (0, 5))
                part = ((digest.view(np.uint64) >> np.uint64(32)) % parts.astype(np.uint64)).astype(np.int64)
                by = np.lexsort((digest, part, anchor))
                cut = np.flatnonzero(np.append(True, (np.diff(anchor[by]) != 0) | (np.diff(part[by]) != 0)))
                for lo, hi in zip(cut, np.append(cut[1:], len(by)), strict=True):
                    own = by[lo:hi]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                         pa.array([anchor[own[0]]]), pa.array([part[own[0]]]),
                         *(pa.array([x[own].astype("<i8").tobytes()], pa.binary()) for x in (digest, doc[at], place[at]))], _COLUMNS)

    return dealt.mapInArrow(run, "doc long, begin long, end long, anchor long, part long, digests binary, docs binary, places binary")


_COLUMNS = ["doc", "begin", "end", "anchor", "part", "digests", "docs", "places"]


def _row(spans: pa.RecordBatch, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*spans.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *(pa.nulls(n, pa.binary()) for _ in range(3))], _COLUMNS)


def _merged(tables: DataFrame) -> DataFrame:
    """Spans to remove because another shard of the same anchor has the string earlier.

    All sorted tables of one (anchor, part) meet; each is looked up in the
    merged table of those before it by binary search, and strings that are new
    are merged in.
    """

    def merge(tables: list[tuple[np.ndarray, ...]]):
        keys, docs, places = (x.copy() for x in tables[0])
        for k, d, p in tables[1:]:
            at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
            hit = keys[at] == k
            where = at[hit]
            earlier = (d[hit] < docs[where]) | ((d[hit] == docs[where]) & (p[hit] < places[where]))
            docs[where[earlier]], places[where[earlier]] = d[hit][earlier], p[hit][earlier]
            slot = np.searchsorted(keys, k[~hit])
            keys, docs, places = (np.insert(x, slot, y[~hit]) for x, y in ((keys, k), (docs, d), (places, p)))
        for k, d, p in tables:
            at = np.searchsorted(keys, k)
            late = (d != docs[at]) | (p != places[at])
            if late.any():
                yield _spans(d[late], p[late])

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for _, group in itertools.groupby(rows(), key=lambda r: r[:2]):
            yield from merge([tuple(np.frombuffer(x, "<i8").copy() for x in r[2:]) for r in group])

    return (tables.select("anchor", "part", "digests", "docs", "places").repartition("anchor", "part")
            .sortWithinPartitions("anchor", "part").mapInArrow(run, "doc long, begin long, end long"))


# ------------------------------------------------------------ the operator
def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a string of 100 bytes that covers it also starts earlier:
    in a smaller doc_id, or in the same document at an earlier place. Texts
    are taken as UTF-8 (null: empty) and strings never cross documents; all
    are judged on the input. Overlapping repeats count. `n_spans`: maximal
    removed runs. Rows that repeat a doc_id are one document, so places equal
    in both are not earlier than each other. A null doc_id comes after all
    others. An empty table gives no rows. `docs` must give the same rows each
    time it is read (a stored table does).
    """
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), "text")
    repeats = written(_repeats(_occurrences(keyed)), "repeats")
    firsts = repeats.filter("first")
    shards = (firsts.groupBy("anchor").agg(F.ceil(F.count("*") / SHARD_SNIPPETS).cast("int").alias("shards")).filter("shards > 1"))
    wanted = (firsts.join(shards, "anchor", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
              .groupBy(F.col("doc").alias("of")).agg(F.collect_list(F.struct("anchor", "snippet", "start", "length", "shards")).alias("wanted")))

    def extract(batches):
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2)
            data, offsets = text_column(batch.column(1))
            for i, doc in enumerate(ids):
                own = data[offsets[i]:offsets[i + 1]]
                asked = wanted.slice(i, 1).flatten()
                anchor, snippet, start, length, shards = (asked.field(k).to_numpy() for k in range(5))
                fits = start + length <= len(own)
                sums = prefix_hash(own)
                same = np.zeros(len(start), bool)  # rows that repeat a doc_id may have other texts
                same[fits] = span_hash(sums, start[fits], (start + length)[fits]).view(np.int64) == snippet[fits]
                flat = own.tobytes()
                pick = np.flatnonzero(same)
                for lo in range(0, len(pick), 5000):
                    at = pick[lo:lo + 5000]
                    shard = (snippet[at].view(np.uint64) >> np.uint64(20)) % shards[at].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[at]), pa.array(shard.astype(np.int32)), pa.array(shards[at].astype(np.int32)),
                         pa.array(np.full(len(at), doc, np.int64)), pa.array(start[at]),
                         pa.array([flat[s:s + n] for s, n in zip(start[at].tolist(), length[at].tolist(), strict=True)], pa.binary())],
                        ["anchor", "shard", "shards", "doc", "start", "text"])

    snippets = (keyed.join(wanted, F.col("doc") == F.col("of")).select("doc", "text", "wanted")
                .mapInArrow(extract, "anchor long, shard int, shards int, doc long, start long, text binary"))
    found = written(_sharded(snippets), "suffix-arrays")
    spans = (repeats.filter("NOT first").select("doc", F.col("start").alias("begin"), (F.col("start") + F.col("length")).alias("end"))
             .unionByName(found.filter("doc IS NOT NULL").select("doc", "begin", "end"))
             .unionByName(_merged(found.filter("anchor IS NOT NULL"))))
    removed = spans.groupBy(F.col("doc").alias("of")).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    judged = docs.join(removed, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)) == F.col("of"), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            ids, spans = batch.column(0), batch.column(2).to_pylist()
            data, offsets = text_column(batch.column(1))
            out = []
            for i, own in enumerate(spans):
                text = data[offsets[i]:offsets[i + 1]]
                if own is None:
                    out.append((len(text), 0, 0, text.tobytes()))
                    continue
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, [min(s["begin"], len(text)) for s in own], 1)
                np.add.at(edge, [min(s["end"], len(text)) for s in own], -1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((len(text), int(gone.sum()), runs, text[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in out], pa.int64()) for k in range(3)),
                                              pa.array([r[3] for r in out], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return judged.mapInArrow(cut, docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary"))
