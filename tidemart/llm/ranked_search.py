"""Ranked lexical search by a dual-tree traversal (operator 13).

Queries ("items") and documents are vectors over the items' terms: an item
holds weight times repeats of each of its terms, a document the saturated
frequency of each term, and a score is their product. Both sides get a
hierarchy whose nodes hold coordinate maxima, so the product of two nodes is
an upper bound of every score below them. A pair of nodes whose bound is
under the weakest kept score of every item below is dropped as a whole, which
loses nothing; what remains at the leaves is scored in integers.

Scores (64-bit integers, division rounds down): with N documents that have a
term, L terms in all, n terms and tf occurrences in a document and df
documents that hold the term,
    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m      = 75 + (25 n N) div L
    score  = sum over the item's terms of weight * ((10**9 tf) div (1000 tf + 12 m))

Results in special cases: a null or empty text has no terms, so such an item
has no rows and such a document is never found; an item whose terms occur
nowhere has no rows; repeated equal (item, text) rows count as one item, an
item_id with several texts is answered for each of them; every row of the
documents is a document, so repeated rows are listed side by side; equal
scores stand in ascending order of the key, nulls first.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import unused, written

#: A term: a maximal run of digits, letters and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter on the items' terms (1 MB at any size of either table).
FILTER_BITS = 23
#: A stored bundle of document vectors holds at most so many documents, or so many entries where one document has fewer.
BUNDLE_DOCS, BUNDLE_ENTRIES = 2048, 1 << 20
#: Items answered in one pass over the vectors, and their (item, term) pairs on average.
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 15
#: Children of a node in both hierarchies; documents in a leaf.
FANOUT, LEAF = 4, 16
#: Cells of the dense matrix that a tree of documents is built on.
TREE_CELLS = 1 << 22
#: Largest sum that doubles add without rounding.
EXACT = float(1 << 53)
#: A bound is a sum of doubles; it may be this share too low.
SLACK = 1 + 1e-9


def terms_of(text: Column) -> Column:
    """The terms of a text in order, with A-Z alone lower-cased (array<string>)."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(number, key, term, times): the terms of every different item row with terms."""
    named = items.select(F.col(item).alias("key"), F.col(text).alias("t")).filter("t IS NOT NULL").distinct()
    numbered = written(named.withColumn("number", F.monotonically_increasing_id()), "search-items")
    return written(numbered.select("number", "key", F.explode(terms_of(F.col("t"))).alias("term"))
                   .groupBy("number", "key", "term").agg(F.count("*").alias("times")), "search-terms")


def _slot(term: str) -> int:
    return zlib.crc32(term.encode()) >> (32 - FILTER_BITS)


def term_filter(terms: DataFrame) -> bytes:
    """A bit for the hash of each term: the merged bitmap has a fixed size and comes in slices of fixed size."""
    slot = F.shiftright(F.crc32(F.col("term").cast("binary")), 32 - FILTER_BITS).cast("int")
    slices = (terms.select(slot.alias("slot")).distinct()
              .groupBy(F.shiftright("slot", 13).alias("part")).agg(F.collect_list(F.col("slot").bitwiseAND(F.lit(8191))).alias("low")))
    flags = np.zeros(1 << FILTER_BITS, bool)
    for row in slices.toLocalIterator():
        flags[(row["part"] << 13) + np.array(row["low"])] = True
    return np.packbits(flags).tobytes()


def document_vectors(docs: DataFrame, wanted: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bundles of documents with terms, restricted to terms that pass the filter.

    (part, seq, docs, terms, keys, sizes, vocabulary, df, edges, codes, tf):
    a bundle of one task, its number there, documents and terms with repeats
    before any restriction; per document its key and terms with repeats; the
    bundle's own vocabulary and in how many of its documents each term is; and
    the sparse rows (edges, codes into the vocabulary, occurrences).
    """
    kind = docs.schema[key].dataType.simpleString()
    flags = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(np.frombuffer(flags.value, np.uint8)).astype(bool)
        find, fold = re.compile(TERM).findall, str.maketrans(UPPER, LOWER)
        held = _Bundle()
        seq = 0
        part = None
        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for i in range(batch.num_rows):
                found = find((batch.column(1)[i].as_py() or "").translate(fold))
                if found:
                    held.add(batch.column(0).slice(i, 1), len(found), [x for x in Counter(found).items() if passes[_slot(x[0])]])
                if held.full():
                    yield held.batch(part, seq)
                    held, seq = _Bundle(), seq + 1
        if held.keys:
            yield held.batch(part, seq)

    schema = (f"part int, seq int, docs long, terms long, keys array<{kind}>, sizes binary, vocabulary array<string>, df array<long>, "
              "edges binary, codes binary, tf binary")
    rows = docs.select(key, text, F.spark_partition_id().alias("part")).filter(F.col(text).isNotNull())
    return written(rows.mapInArrow(run, schema), "search-vectors")


class _Bundle:
    """Documents gathered by one task until they fill a stored row."""

    def __init__(self):
        self.keys, self.sizes, self.edges, self.codes, self.tf, self.index = [], [], [0], [], [], {}

    def full(self) -> bool:
        return len(self.keys) >= BUNDLE_DOCS or len(self.codes) >= BUNDLE_ENTRIES

    def add(self, key: pa.Array, size: int, counts: list[tuple[str, int]]) -> None:
        self.keys.append(key)
        self.sizes.append(size)
        for term, tf in counts:
            self.codes.append(self.index.setdefault(term, len(self.index)))
            self.tf.append(tf)
        self.edges.append(len(self.codes))

    def batch(self, part: int, seq: int) -> pa.RecordBatch:
        codes, keys = np.array(self.codes, np.int32), pa.concat_arrays(self.keys)
        df = np.bincount(codes, minlength=len(self.index))
        columns = {
            "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "docs": pa.array([len(keys)], pa.int64()),
            "terms": pa.array([sum(self.sizes)], pa.int64()), "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            "sizes": pa.array([np.array(self.sizes, np.int64).tobytes()], pa.binary()),
            "vocabulary": pa.array([list(self.index)], pa.list_(pa.string())), "df": pa.array([df.tolist()], pa.list_(pa.int64())),
            "edges": pa.array([np.array(self.edges, np.int64).tobytes()], pa.binary()), "codes": pa.array([codes.tobytes()], pa.binary()),
            "tf": pa.array([np.array(self.tf, np.int64).tobytes()], pa.binary())}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def halves(present: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the rows of a 0/1 matrix that puts like rows together.

    Rows are parted by the column nearest to half of them, then each part
    again, until `leaf` rows are left; parts are cut at multiples of `leaf`,
    so that every leaf of the hierarchy is a run of the order.
    """
    done, stack = [], [np.arange(len(present))]
    while stack:
        rows = stack.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        share = present[rows].sum(axis=0, dtype=np.int64)
        column = int(np.abs(2 * share - len(rows)).argmin())
        order = rows[np.argsort(~present[rows, column], kind="stable")]
        middle = -(-int(share[column]) // leaf) * leaf
        if not 0 < middle < len(rows):
            middle = max(leaf, len(rows) // 2 // leaf * leaf)
        stack += [order[middle:], order[:middle]]
    return np.concatenate(done) if done else np.empty(0, np.int64)


def hierarchy(rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Coordinate maxima of runs of `leaf` rows, then of FANOUT nodes each, up to one root."""
    levels = [np.maximum.reduceat(rows, np.arange(0, len(rows), leaf), axis=0)]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FANOUT), axis=0))
    return levels


class _Items:
    """A block of items: their vectors in hierarchy order, and the k best documents of each so far."""

    def __init__(self, block: dict, k: int):
        self.k, self.index = k, {t: i for i, t in enumerate(block["vocabulary"])}
        dense = np.zeros((len(block["keys"]), len(self.index)), np.int64)
        dense[block["rows"], block["columns"]] = block["values"]
        order = halves(dense > 0, 1)
        self.rows, self.numbers = dense[order], order
        self.levels = hierarchy(self.rows.astype(float), 1)
        self.exact = float(self.rows.sum(axis=1).max(initial=0)) * 1e6 < EXACT
        self.best: list[list] = [[] for _ in order]
        self.kth = block["floors"][order].astype(float)
        self._weakest()

    def _weakest(self) -> None:
        """Of every node, the weakest score that a document must reach to be kept by one of its items."""
        self.need = [self.kth]
        while len(self.need) < len(self.levels):
            self.need.append(np.minimum.reduceat(self.need[-1], np.arange(0, len(self.need[-1]), FANOUT)))

    def offer(self, items: np.ndarray, scores: np.ndarray, keys: list) -> None:
        """Scored documents (columns) for some items (rows)."""
        changed = False
        good = scores >= self.kth[items][:, None]
        for r in np.flatnonzero(good.any(axis=1)).tolist():
            i, best = int(items[r]), self.best[items[r]]
            for c in np.flatnonzero(good[r]).tolist():
                entry = (int(scores[r, c]), _Last(keys[c]))
                if len(best) < self.k:
                    heapq.heappush(best, entry)
                elif best[0] < entry:
                    heapq.heapreplace(best, entry)
            if len(best) == self.k and best[0][0] > self.kth[i]:
                self.kth[i], changed = best[0][0], True
        if changed:
            self._weakest()


class _Last:
    """A key in descending order, nulls last: of equal scores the smallest key counts as the best."""

    __slots__ = ("key",)

    def __init__(self, key):
        self.key = key

    def __lt__(self, other) -> bool:
        if self.key is None or other.key is None:
            return self.key is not None and other.key is None
        return other.key < self.key

    def __eq__(self, other) -> bool:
        return self.key == other.key


class _Documents:
    """A tree over some documents of a bundle."""

    def __init__(self, dense: np.ndarray, keys: list):
        order = halves(dense > 0, LEAF)
        self.rows, self.keys = dense[order], [keys[i] for i in order.tolist()]
        self.levels = hierarchy(self.rows, LEAF)

    def search(self, items: _Items) -> None:
        """Every pair of nodes from the roots down; the most promising documents first, so that bounds rise early."""
        top = len(items.levels) - 1
        stack = [(len(self.levels) - 1, 0, top, np.zeros(1, np.int64))]
        while stack:
            level, node, depth, chosen = stack.pop()
            bound = items.levels[depth][chosen] @ self.levels[level][node]
            chosen = chosen[(bound * SLACK >= items.need[depth][chosen]) & (bound > 0)]
            if not len(chosen):
                continue
            if depth:  # one level down among the items
                chosen = (chosen[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                depth -= 1
                chosen = chosen[chosen < len(items.levels[depth])]
                stack.append((level, node, depth, chosen))
            elif level:  # then among the documents
                below = np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1])))
                promise = (items.levels[0][chosen] @ self.levels[level - 1][below].T).max(axis=0)
                stack += [(level - 1, int(below[j]), 0, chosen) for j in np.argsort(promise)]
            else:
                own = slice(node * LEAF, (node + 1) * LEAF)
                if items.exact:
                    scores = items.rows[chosen].astype(float) @ self.rows[own].T
                else:
                    scores = items.rows[chosen] @ self.rows[own].astype(np.int64).T
                items.offer(chosen, scores, self.keys[own])


def trees(bundle: dict, index: dict[str, int], documents: int, terms: int) -> Iterator[_Documents]:
    """The trees over a stored bundle, each small enough for a dense matrix over the items' terms."""
    if not index:
        return
    sizes, edges, codes, tf = (np.frombuffer(bundle[c], t) for c, t in
                               (("sizes", np.int64), ("edges", np.int64), ("codes", np.int32), ("tf", np.int64)))
    place = np.array([index.get(t, -1) for t in bundle["vocabulary"]], np.int64)
    m = [75 + 25 * n * documents // terms for n in sizes.tolist()]
    step = max(LEAF, TREE_CELLS // len(index))
    for lo in range(0, len(sizes), step):
        hi = min(lo + step, len(sizes))
        own = slice(int(edges[lo]), int(edges[hi]))
        row = np.repeat(np.arange(hi - lo), np.diff(edges[lo:hi + 1]))
        column = place[codes[own]] if len(place) else np.empty(0, np.int64)
        known = column >= 0
        row, column, times = row[known], column[known], tf[own][known]
        weight = np.array(m[lo:hi], object).astype(np.int64)
        dense = np.zeros((hi - lo, len(index)))
        dense[row, column] = 1_000_000_000 * times // (1000 * times + 12 * weight[row])
        some = np.flatnonzero(dense.any(axis=1))
        if len(some):
            yield _Documents(dense[some], [bundle["keys"][lo + i] for i in some.tolist()])


def _block(pairs: list, documents: int, floors: dict) -> dict:
    """A block of items as sparse rows; the weights are computed once, here."""
    numbers = sorted({p["number"] for p in pairs})
    vocabulary = sorted({p["term"] for p in pairs})
    row, column = {n: i for i, n in enumerate(numbers)}, {t: i for i, t in enumerate(vocabulary)}
    return {"keys": numbers, "vocabulary": vocabulary, "floors": np.array([max(1, floors.get(n, 1)) for n in numbers], np.int64),
            "rows": np.array([row[p["number"]] for p in pairs]), "columns": np.array([column[p["term"]] for p in pairs]),
            "values": np.array([p["times"] * math.floor(1000 * math.log((2 * documents + 2) / (2 * p["df"] + 1))) for p in pairs], np.int64)}


def _search(vectors: DataFrame, block: dict, k: int, documents: int, terms: int, kind: str) -> DataFrame:
    """(number, key, score): of each task the k best documents of every item, none under the item's floor."""
    sent = vectors.sparkSession.sparkContext.broadcast(block)
    key_type = to_arrow_type(vectors.schema["keys"].dataType.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _Items(sent.value, k)
        for batch in batches:
            for i in range(batch.num_rows):
                bundle = batch.slice(i, 1).to_pylist()[0]
                for tree in trees(bundle, items.index, documents, terms):
                    tree.search(items)
        found = [(sent.value["keys"][int(items.numbers[i])], last.key, score) for i, best in enumerate(items.best) for score, last in best]
        if found:
            numbers, keys, scores = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(keys, key_type), pa.array(scores, pa.int64())], ["number", "key", "score"])

    return vectors.select("keys", "sizes", "vocabulary", "edges", "codes", "tf").mapInArrow(run, f"number long, key {kind}, score long")


def best_of(found: DataFrame, k: int, rank: str = "rank") -> DataFrame:
    """The k best rows of each item: first of each of 64 parts of its rows, then of what is left."""
    def top(rows: DataFrame, *by: str) -> DataFrame:
        best = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("key").asc_nulls_first())
        return rows.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= k)

    parted = found.withColumn("salt", F.spark_partition_id() % 64)
    return top(top(parted, "number", "salt").drop(rank, "salt"), "number")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): the k best documents of every item, of those with a score above 0.

    The documents are tokenised once and stored as vectors over the items'
    terms. Items are answered in blocks; a block first meets one bundle of
    each task, whose k-th scores are floors for the pass over everything: k
    real documents reach them, so nothing under them can be among the k best.
    The name of the item column is kept, with underscores added if the
    documents' key has it too.
    """
    kind = docs.schema[key].dataType.simpleString()
    terms = item_terms(items, item, item_text)
    vectors = document_vectors(docs, term_filter(terms), key, text)
    documents, total = vectors.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    df = (vectors.select(F.explode(F.arrays_zip("vocabulary", "df")).alias("v"))
          .groupBy(F.col("v.vocabulary").alias("term")).agg(F.sum("v.df").alias("df")))
    known = written(terms.join(df, "term"), "search-known")
    size = known.agg(F.countDistinct("number"), F.count("*")).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_TERMS))
    spread = F.pmod(F.xxhash64("number"), F.lit(blocks))
    found = None
    for b in range(blocks if size[0] else 0):
        pairs = known.filter(spread == b).select("number", "term", "times", "df").collect()  # one block: bounded above
        if not pairs:
            continue
        first = best_of(_search(vectors.filter("seq = 0"), _block(pairs, documents, {}), k, documents, total, kind), k)
        floors = {r["number"]: r["floor"] for r in first.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
                  .filter(F.col("n") == k).collect()}  # one row per item of the block
        own = written(best_of(_search(vectors, _block(pairs, documents, floors), k, documents, total, kind), k), "search-found")
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"number long, key {kind}, score long, rank int")
    names = terms.select("number", F.col("key").alias("item")).distinct()
    out = unused(docs.select(key), item)[0]
    return found.join(names, "number").select(F.col("item").alias(out), F.col("rank").cast("int").alias("rank"),
                                              F.col("key").alias(key), "score")


#: The same ranking as SQL over the `documents` and `benchmark` views.
SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
freq AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term),
lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM freq GROUP BY r),
totals AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
df AS (SELECT term, count(*) AS df FROM freq GROUP BY term),
asked AS (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
weights AS (SELECT q, item_id, a.term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS w
  FROM asked a JOIN df ON a.term = df.term, totals),
scores AS (
  SELECT q, item_id, f.r, f.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM weights x JOIN freq f ON x.term = f.term JOIN lengths l ON l.r = f.r, totals GROUP BY q, item_id, f.r, f.doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS FIRST) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
WHERE rank <= 20
"""
