"""Token ids in a bit-plane binary format (operator 3).

The ids of all documents, in ascending document order, form one stream. It is
cut into blocks of a fixed number of ids; a block is transposed into byte or
bit planes, each plane is compressed by zstandard, and the block's row also
holds its part of the index: which document's ids lie where. The container is
Parquet, so Spark's committer makes retries and lost executors harmless and
any store that Spark can write will do; the index columns can be read without
the planes.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import part_offsets
from .pretokens import PieceCache

BLOCK_IDS = 1 << 16
#: Pieces whose ids a worker process keeps; beyond them it starts anew. Speed alone depends on it.
CACHED_PIECES = 700_000
SCHEMA = ("part int, block int, n_ids int, layout string, planes array<binary>, doc_seq array<long>, doc_id array<long>, "
          "doc_start array<long>, doc_tokens array<long>, begin array<int>, length array<int>, piece array<int>")


def to_planes(ids: np.ndarray, layout: str = "byte") -> list[bytes]:
    """The block's planes, compressed. Plane i holds byte (or bit) i of every id, lowest first."""
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if layout == "byte":
        planes = as_bytes.T
    elif layout == "bit":
        planes = np.packbits(np.unpackbits(as_bytes, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    press = zstandard.ZstdCompressor(level=1)
    return [press.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int, layout: str = "byte") -> np.ndarray:
    """The ids of a block; the inverse of `to_planes`."""
    open_ = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(open_.decompress(p), np.uint8) for p in planes]
    if layout == "byte":
        return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel()
    bits = np.stack([np.unpackbits(p, count=n_ids, bitorder="little") for p in raw], axis=1)
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<u4").ravel()


class _Encoder:
    """The tokenizer's ids of whole texts: its added tokens are cut out of a text first, as the library does,
    and the stretches between them are encoded from the pieces that this worker process has met."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        added = model.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take neighbours with them are not supported")
        self.added = {t.content: i for i, t in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.cache = PieceCache(lambda pieces: [e.ids for e in model.encode_batch_fast(pieces, add_special_tokens=False)], limit=CACHED_PIECES)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and per text the offset of its first id (one more at the end)."""
        found = [list(self.cut.finditer(t)) if self.cut else [] for t in texts]
        if not any(found):
            return self.cache.ids(texts)
        stretches, marks = [], []  # per text: its stretches, and the added token after each but the last
        for t, hits in zip(texts, found, strict=True):
            edges = [0, *(x for h in hits for x in h.span()), len(t)]
            stretches += [t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
            marks += [self.added[h.group()] for h in hits] + [None]
        ids, first = self.cache.ids(stretches)
        parts, ends, held = [], [0], 0
        for i, mark in enumerate(marks):
            parts.append(ids[first[i]:first[i + 1]])
            held += len(parts[-1])
            if mark is None:
                ends.append(held)
            else:
                parts.append(np.array([mark], np.uint32))
                held += 1
        return np.concatenate(parts), np.array(ends)


@functools.cache
def _encoder(tokenizer: str) -> _Encoder:
    """Kept from task to task of a worker process."""
    return _Encoder(tokenizer)


class _Writer:
    """Collects ids and gives block rows; holds one block and the documents that lie in it."""

    def __init__(self, part: int, block_ids: int, layout: str):
        self.part, self.block_ids, self.layout = part, block_ids, layout
        self.block = self.at = self.seq = self.held = 0
        self.ids: list[np.ndarray] = []
        self.index: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray):
        start, done, piece = self.at, 0, 0
        while done < len(ids):
            take = ids[done:done + self.block_ids - self.held]
            self.index.append((self.seq, doc_id, start, len(ids), self.held, len(take), piece))
            self.ids.append(take)
            self.held, done, piece = self.held + len(take), done + len(take), piece + 1
            if self.held == self.block_ids:
                yield self.flush()
        self.seq, self.at = self.seq + 1, start + len(ids)

    def flush(self) -> dict:
        columns = [list(c) for c in zip(*self.index, strict=True)]
        row = dict(zip(("doc_seq", "doc_id", "doc_start", "doc_tokens", "begin", "length", "piece"), columns, strict=True))
        row |= {"part": self.part, "block": self.block, "n_ids": self.held, "layout": self.layout,
                "planes": to_planes(np.concatenate(self.ids), self.layout)}
        self.ids, self.index, self.held, self.block = [], [], 0, self.block + 1
        return row


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, layout: str = "byte",
                 block_ids: int = BLOCK_IDS, text: str = "text", order: str = "doc_id") -> None:
    """Encodes every whole text and writes the id stream to `path`.

    Null and empty texts give the end id alone. Documents follow ascending
    `order`, nulls first; rows with equal ids keep any order. An added token of
    the tokenizer inside a text is one id, as the library has it with
    add_special_tokens=False. An empty table writes no block.
    """
    schema = docs.sparkSession.createDataFrame([], SCHEMA).schema

    def encode(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder = _encoder(tokenizer)
        out = _Writer(TaskContext.get().partitionId(), block_ids, layout)
        arrow = to_arrow_schema(schema)
        last = np.array([end_id], np.uint32)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _runs(texts):
                ids, first = encoder.ids(texts[a:b])
                for i in range(b - a):
                    for row in out.add(keys[a + i], np.concatenate([ids[first[i]:first[i + 1]], last])):
                        yield pa.RecordBatch.from_pylist([row], arrow)
        if out.held:
            yield pa.RecordBatch.from_pylist([out.flush()], arrow)

    (docs.select(F.col(order).cast("long"), F.col(text))
     .repartitionByRange(F.col(order).asc_nulls_first()).sortWithinPartitions(F.col(order).asc_nulls_first())
     .mapInArrow(encode, schema).write.option("compression", "uncompressed").parquet(path))


def _runs(texts: list[str], limit: int = 1 << 20):
    """Row ranges with about `limit` characters each."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > limit:
            yield first, i
            first, held = i, 0
        held += len(t)
    if first < len(texts):
        yield first, len(texts)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files.

    `start` counts the ids of all documents before it; `ids` are its ids as
    little-endian unsigned 32-bit integers. Documents inside one block are cut
    out where the block is read; only those that cross a block edge are
    gathered, piece by piece.
    """
    schema = spark.createDataFrame([], SCHEMA).schema
    blocks = spark.read.schema(schema).parquet(path)

    def cut(crossing: bool):
        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    rows = [(q, d, s, n, p, b, k) for q, d, s, n, b, k, p in
                            zip(r["doc_seq"], r["doc_id"], r["doc_start"], r["doc_tokens"], r["begin"], r["length"],
                                r["piece"], strict=True) if (k < n) == crossing]
                    if not rows:
                        continue
                    ids = from_planes(r["planes"], r["n_ids"], r["layout"]).astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["part"]] * len(rows), pa.int32()), *(pa.array([x[i] for x in rows], pa.int64()) for i in range(4)),
                         pa.array([x[4] for x in rows], pa.int32()),
                         pa.array([ids[b:b + k].tobytes() for *_, b, k in rows], pa.binary())],
                        ["part", "doc_seq", "doc_id", "doc_start", "n_tokens", "piece", "ids"])

        return blocks.mapInArrow(run, "part int, doc_seq long, doc_id long, doc_start long, n_tokens long, piece int, ids binary")

    keys = ["part", "doc_seq", "doc_id", "doc_start", "n_tokens"]
    pieces = F.array_sort(F.collect_list(F.struct("piece", F.hex("ids").alias("ids"))))
    joined = (cut(True).groupBy(*keys).agg(pieces.alias("p"))
              .select(*keys, F.unhex(F.array_join("p.ids", "")).alias("ids")))
    docs = cut(False).drop("piece").unionByName(joined)
    offsets = part_offsets(blocks.groupBy(F.col("part").alias("_part")).agg(F.sum("n_ids").alias("_n")), ["_part"])
    return (docs.join(F.broadcast(offsets), docs["part"] == offsets["_part"])
            .select("doc_id", (F.col("_before") + F.col("doc_start")).alias("start"), "n_tokens", "ids"))
