"""Near copies among embeddings by sorted projection passes (operator 11).

Each pass draws random rotations and orders the vectors lexicographically by
their concatenated hashes (the axis a rotated vector is nearest to, with its
sign), so that like vectors tend to stand near each other. A vector is then
compared with the vectors of its label in a bounded window after it, by cosine
in double precision. Pairs that reach the threshold are links; links of all
passes are united.

A pair may stand within the window in several passes. Each vector carries its
place in every pass, so a pair is counted where it is met first, and counts of
links add up without any list of pairs: a block of the order returns per
vector the number of its new links and its root among the block's links. Equal
vectors are one class until the end, so groups of copies are compared once.

The number of passes follows from the number of classes of the commonest
label: enough for the wanted recall at the threshold, where a pass finds a
pair if its hashes agree as long as more classes than a window share them.

Results in special cases: a vector that is null, empty, zero, or holds null or
non-finite components, or whose label is null, links with nothing and is its
own component; so does a row without a key, which has no component and is not
kept. Vectors of different lengths never link. Rows that repeat (key, label,
vector) are one row; rows that share a key alone are vectors of their own,
whose component is the smallest key in it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import part_offsets, saved, written
from .components import components

COSINE = 0.93
#: Later neighbours that a vector is compared with in each pass; vectors of a block; rows of one tile of a block.
WINDOW, BLOCK, TILE = 1024, 4096, 256
#: Share of the pairs at the threshold that all passes together are to find, and passes at least.
RECALL, LEAST_PASSES = 0.999, 3
#: Hashes that make up a sort key, two bytes each.
HASHES = 6
SEED = 20_11


@functools.cache
def rotations(pass_number: int, size: int) -> np.ndarray:
    """HASHES random orthogonal matrices (hash, size, size) of one pass."""
    draw = np.random.default_rng([SEED, pass_number, size])
    return np.stack([np.linalg.qr(draw.standard_normal((size, size)))[0] for _ in range(HASHES)])


def hash_keys(unit: np.ndarray, pass_number: int) -> np.ndarray:
    """Per unit vector its HASHES hashes, most significant first, as bytes that sort like the numbers."""
    size = unit.shape[1]
    out = np.empty((len(unit), HASHES), ">u2")
    for h, turn in enumerate(rotations(pass_number, size)):
        turned = unit @ turn
        axis = np.abs(turned).argmax(axis=1)
        out[:, h] = (2 * axis + (turned[np.arange(len(unit)), axis] < 0)) % 65_536
    return out


@functools.cache
def agreement(size: int, cosine: float) -> float:
    """Probability, by simulation with a fixed seed, that two vectors at this cosine have the same hash."""
    if size < 2:
        return 1.0
    draw = np.random.default_rng([SEED, size])
    a, b = draw.standard_normal((2, 4000, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = cosine * a + math.sqrt(1 - cosine * cosine) * b
    return float(min(max((hash_keys(a, 0) == hash_keys(c, 0)).mean(), 0.01), 0.999))


def passes_needed(largest: int, size: int, cosine: float, window: int, recall: float) -> int:
    """Passes for a label with `largest` classes of vectors of `size` components."""
    shared = max(0.0, math.log(max(largest, 1) / window, 2 * size)) if size > 1 else 0.0
    found = min(agreement(size, cosine) ** shared, 0.999)
    return max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def can_link(key: str, vector: str, label: str) -> Column:
    """Whether a row has a key, a label and a vector with a direction."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _places(classes: DataFrame, passes: int) -> DataFrame:
    """(id, places): the place of every class in the order of every pass, counted without gaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows in _by_size(batch.column(1)):
                unit = _unit(batch.column(1).take(pa.array(rows)), size)
                ids = batch.column(0).take(pa.array(rows))
                for p in range(passes):
                    keys = hash_keys(unit, p)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([p] * len(rows), pa.int32()), pa.array([k.tobytes() for k in keys], pa.binary()),
                         pa.array([size] * len(rows), pa.int32())], ["id", "pass", "hash", "size"])

    keyed = classes.select("id", "v").mapInArrow(run, "id long, pass int, hash binary, size int").join(classes.select("id", "label"), "id")
    order = ["pass", "label", "size", "hash", "id"]
    ranged = (keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
              .select("id", "pass", F.shiftright("at", 33).cast("int").alias("_part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("row")))
    ranged = written(ranged, "vector-order")
    counts = ranged.groupBy("_part", "pass").agg(F.count("*").alias("_n"), F.min("row").alias("first"))
    offsets = part_offsets(counts, ["_part", "pass"]).join(counts.select("_part", "pass", "first"), ["_part", "pass"])
    placed = ranged.join(offsets, ["_part", "pass"]).select("id", "pass", (F.col("_before") + F.col("row") - F.col("first")).alias("place"))
    return placed.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "place"))), lambda x: x["place"]).alias("places"))


def _by_size(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    sizes = np.diff(column.offsets.to_numpy())
    return [(int(s), np.flatnonzero(sizes == s)) for s in np.unique(sizes)]


def _unit(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as unit rows; scaled first, so that no square over- or underflows."""
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(float)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _links_of_block(vectors: np.ndarray, labels: np.ndarray, places: np.ndarray, ids: np.ndarray, weights: np.ndarray,
                    pass_number: int, main: int, cosine: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(links met here first, smallest id in the block's links) per row; rows after `main` are only partners."""
    count = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    order = places[:, pass_number]
    for lo in range(0, main, TILE):
        hi = min(lo + TILE, main)
        end = int(np.searchsorted(order, order[hi - 1] + window, "right"))
        near = vectors[lo:hi] @ vectors[lo:end].T >= cosine
        gap = order[lo:end][None, :] - order[lo:hi, None]
        a, b = np.nonzero(near & (gap > 0) & (gap <= window) & (labels[lo:hi, None] == labels[lo:end][None, :]))
        a, b = a + lo, b + lo
        for p in range(pass_number):  # a pair within the window of an earlier pass was counted there
            new = np.abs(places[a, p] - places[b, p]) > window
            a, b = a[new], b[new]
        np.add.at(count, a, weights[b])
        np.add.at(count, b, weights[a])
        while len(a):  # smallest position over links, until nothing changes
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            root = root[root]
            if (root == before).all():
                break
    while (root[root] != root).any():
        root = root[root]
    least = ids.copy()
    np.minimum.at(least, root, ids)
    return count, least[root]


def near_vectors(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 window: int = WINDOW, recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) of every different row.

    `n_links` counts the other vectors linked with the row directly,
    `component_id` is the smallest key reachable over links, itself included,
    and `kept` marks the row that has it as its key.
    """
    if not 0 < window <= BLOCK:
        raise ValueError(f"window must be 1 to {BLOCK}")
    named = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v")).distinct()
    rows = written(named.withColumn("usable", can_link("key", "v", "label")), "vectors")
    usable = rows.filter("usable").drop("usable")
    found = usable.groupBy("label", "v").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    classes = written(found.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    most = classes.groupBy("label", F.size("v").alias("size")).count().groupBy("size").agg(F.max("count").alias("n"))
    passes = max((passes_needed(r["n"], r["size"], cosine, window, recall) for r in most.toLocalIterator()), default=LEAST_PASSES)
    placed = written(classes.join(_places(classes, passes), "id"), "vector-places")
    block = F.floor(F.col("place") / BLOCK)
    at = placed.select("id", "label", "v", "copies", "places", F.posexplode("places").alias("pass", "place"))
    dealt = at.select("*", F.explode(F.when((F.col("place") % BLOCK < window) & (F.col("place") >= BLOCK), F.array(block, block - 1))
                                     .otherwise(F.array(block))).alias("block"))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("place")
        number, start = group["pass"][0].as_py(), group["block"][0].as_py() * BLOCK
        place = group["place"].to_numpy()
        main = int(np.searchsorted(place, start + BLOCK))
        ids, weights = group["id"].to_numpy(), group["copies"].to_numpy()
        places = np.array(group["places"].combine_chunks().flatten()).reshape(len(ids), passes)
        # a label of this block as a number; vectors of different lengths are different labels
        column = group["v"].combine_chunks()
        names = group["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        links, roots = np.zeros(len(ids), np.int64), ids.copy()
        for size, at in _by_size(column):
            own_main = int((at < main).sum())
            unit = _unit(column.take(pa.array(at)), size)
            links[at], roots[at] = _links_of_block(unit, names[at], places[at], ids[at], weights[at], number, own_main, cosine, window)
        some = np.flatnonzero(links)
        return pa.table({"id": ids[some], "links": links[some], "root": roots[some]})

    met = written(dealt.groupBy("pass", "block").applyInArrow(run, "id long, links long, root long"), "vector-links")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(met.filter("id <> root").select("id", "root").distinct(), "id", "root")
    linked = saved(classes.join(links, "id", "left").join(groups, "id", "left")
                   .select("label", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                           F.coalesce("component", "id").alias("component")))
    heads = linked.groupBy("component").agg(F.min("least").alias("head"))
    marked = usable.join(linked.join(heads, "component"), ["label", "v"]).select("key", "links", F.col("head").alias("component"))
    alone = rows.filter("NOT usable").select("key", F.lit(0).alias("links"), F.col("key").alias("component"))
    return marked.unionByName(alone).select(
        F.col("key").alias(key), F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("key") == F.col("component"), F.lit(False)).alias("kept"))
