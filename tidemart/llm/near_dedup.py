"""Near-duplicate groups from SetSketch registers (operator 5).

A register holds the exponentially spaced, truncated minimum of one hash over
a document's shingles; registers of parts merge by maximum, and two registers
are equal about as often as the sets are similar. Bands of registers put
similar documents into common buckets; the similarity of two documents is
estimated jointly from all their registers by maximum likelihood, and every
pair that may reach the threshold is verified on the full shingle sets.

Documents with equal sets are one class from the start. In a bucket, each
class first meets only the bucket's most central class. Where classes of a
bucket are still in different components after that, the classes outside the
bucket's main component meet the others in blocks of fixed size, first their
most similar ones, then all that remain, so no pair of a common bucket stays
untested unless both are in one component already.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, saved, written
from .components import components
from .kernels import chunks, combine, mix, shingle_sets, text_column

WIDTH = 5
#: Registers of a sketch; the first BANDS * ROWS of them make the buckets, all serve the estimate.
REGISTERS, BANDS, ROWS = 256, 30, 5
#: Base of the registers' spacing, rate of the exponentials, largest register.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: Standard errors below the threshold at which an estimate still leads to verification.
MARGIN = 4.0
#: Classes of a bucket that meet in one block.
BLOCK = 1024
#: Classes on either side of a cell of pairs that are verified together; a cell gets each text once.
CELL = 32
#: Candidates that a class sends to verification in the successive rounds; None: all.
WIDENING = (8, None)


@functools.cache
def _factors() -> np.ndarray:
    return mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Register values (sets x REGISTERS); no set may be empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    flat = np.concatenate(sets)
    least = np.stack([np.minimum.reduceat(flat * f, starts) for f in _factors()], axis=1)
    spaced = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(spaced, 1e-300)) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_hashes(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of registers (sets x BANDS)."""
    wide = values[:, :BANDS * ROWS].astype(np.uint64).reshape(len(values), BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for r in range(ROWS):
        out = mix(out) + wide[:, :, r]
    return mix(out)


def estimate(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest similarity, given how many of a's registers are larger than, smaller than and equal to b's."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, 101)[None, :]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    like = larger[:, None] * log(up) + smaller[:, None] * log(down) + equal[:, None] * log(1 - up - down)
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]


def lowest_estimate(threshold: float) -> float:
    return threshold - MARGIN * float(np.sqrt(threshold * (1 - threshold) / REGISTERS))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers) of every row; no words: 0 and nulls."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_column(batch.column(1))
            for a, b in chunks(offsets):
                sets = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], WIDTH)
                full = [s for s in sets if len(s)]
                values = registers(full) if full else np.empty((0, REGISTERS), np.uint16)
                keys = (hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in full)
                rows = zip(keys, (v.tobytes() for v in values), strict=True)
                got = [next(rows) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array([g[0] for g in got], pa.binary()),
                     pa.array([g[1] for g in got], pa.binary())], ["doc_id", "n_shingles", "set_key", "registers"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, registers binary")


def buckets(classes: DataFrame) -> DataFrame:
    """(class, band, bucket): the buckets of every class, from its registers."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                hashes = band_hashes(_matrix(part.column(1).to_pylist())).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashes.tolist(), pa.list_(pa.int64()))], ["class", "bands"])

    return classes.select("class", "registers").mapInArrow(run, "class long, bands array<long>").select(
        "class", F.posexplode("bands").alias("band", "bucket"))


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, cell) whose estimate may reach the threshold."""
    slim = classes.select("class", "n", "registers")
    x = slim.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    y = slim.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    lowest = lowest_estimate(threshold)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            r_a, r_b = (_matrix(col[c].to_pylist()) for c in ("r_a", "r_b"))
            n_a, n_b = (col[c].to_numpy().astype(float) for c in ("n_a", "n_b"))
            got = estimate((r_a > r_b).sum(1), (r_a < r_b).sum(1), (r_a == r_b).sum(1), n_a, n_b)
            keep = (got >= lowest) & (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(col[c].to_numpy()[keep]) for c in ("a", "b", "cell")], ["a", "b", "cell"])

    return (pairs.join(x, "a").join(y, "b").select("a", "b", "cell", "n_a", "n_b", "r_a", "r_b")
            .mapInArrow(run, "a long, b long, cell long"))


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), -1)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full shingle sets.

    The pairs of a cell are verified in one task, which gets each of the
    cell's texts once: a family of like texts in which all pairs have to be
    verified costs its texts once for every CELL of its members, not once for
    every pair.
    """
    ends = (pairs.select("cell", F.col("a").alias("doc_id")).distinct()
            .unionByName(pairs.select("cell", F.col("b").alias("doc_id")).distinct()).distinct())
    none = F.lit(None)
    rows = (ends.join(texts, "doc_id").select("cell", F.lit(0).alias("kind"), F.col("doc_id").alias("a"), none.cast("long").alias("b"), "text")
            .unionByName(pairs.select("cell", F.lit(1).alias("kind"), "a", "b", none.cast("string").alias("text")))
            .repartition("cell").sortWithinPartitions("cell", "kind").select("cell", "kind", "a", "b", "text"))

    def like(p: np.ndarray, q: np.ndarray) -> bool:
        both = len(p) + len(q) - len(np.union1d(p, q))
        return 100 * both >= percent * (len(p) + len(q) - both)

    def run(batches):
        cell, held = None, {}
        for batch in batches:
            data, offsets = text_column(batch.column(4))
            cells, kinds, a, b = (batch.column(i).to_pylist() for i in range(4))
            found = []
            for lo, hi in chunks(offsets):
                sets = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], WIDTH)
                for i in range(lo, hi):
                    if cells[i] != cell:
                        cell, held = cells[i], {}
                    if kinds[i] == 0:  # a document may have several texts
                        held.setdefault(a[i], []).append(sets[i - lo])
                    elif any(like(p, q) for p in held[a[i]] for q in held[b[i]]):
                        found.append((a[i], b[i]))
            if found:
                yield _pairs(found)

    return rows.mapInArrow(run, "a long, b long")


def _open_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, threshold: float, most: int | None) -> DataFrame:
    """Likely pairs (a, b, cell) of classes that share a bucket but not yet a component.

    Of each bucket, the classes outside its main component (the one with most
    classes there) meet all classes, block by block. `most`: how many of its
    most similar classes each sends on from a block.
    """
    known = (members.join(labels.withColumnRenamed("id", "class"), "class", "left")
             .select("band", "bucket", "class", F.coalesce("component", "class").alias("component")))
    counts = known.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mains = (counts.groupBy("bucket").agg(F.max(F.struct("n", -F.col("component"))).alias("m"), F.sum("n").alias("n"), F.count("*").alias("k"))
             .filter("k > 1").select("bucket", (-F.col("m")["col2"]).alias("main"),
                                     F.ceil((F.col("n") - F.col("m")["n"]) / BLOCK).cast("int").alias("outer"),
                                     F.ceil(F.col("n") / BLOCK).cast("int").alias("all")))
    rows = known.join(mains, "bucket").withColumn("h", F.xxhash64("class"))
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    outer = (rows.filter("component <> main")
             .select("bucket", "band", "class", "component", F.pmod("h", F.col("outer")).cast("int").alias("x"), F.explode(span("all")).alias("y"), F.lit(0).alias("side")))
    every = rows.select("bucket", "band", "class", "component", F.explode(span("outer")).alias("x"), F.pmod("h", F.col("all")).cast("int").alias("y"), F.lit(1).alias("side"))
    placed = (outer.select(*every.columns).unionByName(every)
              .join(classes.select("class", "n", "registers"), "class")
              .repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "side", "class")
              .select("bucket", "x", "y", "side", "band", "class", "component", "n", "registers"))
    lowest = lowest_estimate(threshold)

    def meet(key, band, ids, comps, ns, regs, n_outer):
        out = []
        block = mix(mix(np.array(key[:1], np.int64).view(np.uint64)) + np.uint64((key[1] << 32) + key[2] + 1))[0]
        for lo in range(0, n_outer, 64):
            hi = min(lo + 64, n_outer)
            same = regs[lo:hi, None, :] == regs[None, n_outer:, :]
            equal = same.sum(2)
            size_a, size_b = ns[lo:hi, None], ns[None, n_outer:]
            ok = (comps[lo:hi, None] != comps[None, n_outer:]) & (np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b) - 1e-9)
            ok &= equal >= REGISTERS * (lowest - 0.1)
            i, j = np.nonzero(ok)
            if not len(i):
                continue
            first = same[i, j, :BANDS * ROWS].reshape(len(i), BANDS, ROWS).all(2).argmax(1) == band  # in the first band they share, once
            i, j = i[first], j[first]
            if not len(i):
                continue
            r_a, r_b = regs[lo + i], regs[n_outer + j]
            got = estimate((r_a > r_b).sum(1), (r_a < r_b).sum(1), equal[i, j], ns[lo + i], ns[n_outer + j])
            cells = mix(block + ((lo + i) // CELL).astype(np.uint64) * np.uint64(1 << 32) + (j // CELL).astype(np.uint64)).view(np.int64)
            best: dict[int, int] = {}
            for k in np.argsort(-got, kind="stable").tolist():
                if got[k] < lowest or (most is not None and best.get(i[k], 0) >= most):
                    continue
                best[i[k]] = best.get(i[k], 0) + 1
                out.append((int(ids[lo + i[k]]), int(ids[n_outer + j[k]]), int(cells[k])))
        return out

    def run(batches):
        def flat():
            for batch in batches:
                c = [batch.column(i) for i in range(batch.num_columns)]
                keys = list(zip(c[0].to_pylist(), c[1].to_pylist(), c[2].to_pylist(), strict=True))
                yield from zip(keys, c[3].to_pylist(), c[4].to_pylist(), c[5].to_pylist(), c[6].to_pylist(), c[7].to_pylist(),
                               c[8].to_pylist(), strict=True)

        held: list[tuple[int, int, int]] = []
        for key, group in itertools.groupby(flat(), key=lambda r: r[0]):
            group = list(group)  # at most about 2 * BLOCK rows
            ids, comps = (np.array([r[k] for r in group]) for k in (3, 4))
            held += meet(key, group[0][2], ids, comps, np.array([r[5] for r in group], float), _matrix([r[6] for r in group]),
                         sum(r[1] == 0 for r in group))
            if len(held) > 10_000:
                yield _pairs(held)
                held = []
        if held:
            yield _pairs(held)

    return placed.mapInArrow(run, "a long, b long, cell long").groupBy("a", "b").agg(F.min("cell").alias("cell"))


def _pairs(held: list[tuple]) -> pa.RecordBatch:
    """Pairs in ascending order, with their cells if they have any."""
    columns = [pa.array([min(p[:2]) for p in held], pa.int64()), pa.array([max(p[:2]) for p in held], pa.int64())]
    if len(held[0]) == 3:
        columns.append(pa.array([p[2] for p in held], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "cell"][:len(columns)])


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents link when 100 * intersection >= percent * union of their 5-word
    shingle sets (fewer words: the whole sequence is one shingle). A text
    without words, or null, has the empty set and links with nothing.
    `component_id` is the smallest doc_id reachable over links; `kept` is
    doc_id = component_id. Rows that repeat a doc_id are one document (all its
    texts are in one component). A null doc_id cannot be named: its row has a
    null component_id, is kept and links with nothing. An empty table gives
    no rows.
    """
    threshold = percent / 100
    sketched = written(sketches(docs), "sketches")
    named = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(named.groupBy("set_key").agg(
        F.min("doc_id").alias("class"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "classes")
    banded = buckets(classes).distinct()
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = written(banded.join(sizes, "bucket"), "members")

    scores = members.groupBy("class").agg(F.sum("size").alias("score"))
    central = (members.join(scores, "class").groupBy("bucket")
               .agg(F.max(F.struct("score", (-F.col("class")).alias("c"))).alias("m")).select("bucket", (-F.col("m.c")).alias("b")))
    met = members.join(central, "bucket").filter("class <> b").select("class", F.col("b").alias("hub")).distinct()
    hubs = met.groupBy("hub").agg(F.ceil(F.count("*") / CELL).alias("parts"))  # a hub's pairs are verified in cells
    cell = F.xxhash64("hub", F.pmod(F.xxhash64("class"), "parts"))
    stars = (met.join(hubs, "hub").groupBy(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
             .agg(F.min(cell).alias("cell")))
    texts = written(docs.select(F.col("doc_id").cast("long"), "text")
                    .join(members.select(F.col("class").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")
    # one document with several texts joins their classes
    same = (named.join(classes.select("set_key", "class"), "set_key").filter("doc_id <> class")
            .select(F.col("class").alias("a"), F.col("doc_id").alias("b")).distinct())
    repeated = same.join(named.join(classes.select("set_key", "class"), "set_key").filter("doc_id = class").select(F.col("doc_id").alias("b")).distinct(), "b")

    tested = saved(_likely(stars, classes, threshold))
    links = saved(_verified(tested, texts, percent).unionByName(repeated.select("a", "b")))
    release(docs.sparkSession)
    for most in WIDENING:
        fresh = saved(_open_pairs(members, components(links), classes, threshold, most).join(tested.drop("cell"), ["a", "b"], "left_anti"))
        links = saved(links.unionByName(_verified(fresh, texts, percent)))
        tested = tested.unionByName(fresh)
        release(docs.sparkSession)

    labels = components(links).withColumnRenamed("id", "class")
    by_set = classes.select("set_key", "class").join(labels, "class", "left").select("set_key", F.coalesce("component", "class").alias("c"))
    return (sketched.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
