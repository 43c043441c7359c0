"""Sharding by longest-processing-time scheduling (operator 6).

Groups that must stay together (equal texts) are scheduled, largest first,
onto the least-loaded shard through a heap. A group above 1/512 of a fair
shard is a unit of its own (at most 512 x shards of them exist); the smaller
groups are hashed into 512 x shards bundles and each bundle is one unit. So
the heap always sees a bounded number of units, whatever the input, and the
rows themselves never leave the executors.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import part_offsets, written

UNITS_PER_SHARD = 512


def longest_first(units: list[tuple[int, int]], n_shards: int) -> dict[int, int]:
    """(size, unit) pairs -> shard of each unit. Ties: smaller unit first, lower shard first."""
    load = [(0, s) for s in range(n_shards)]
    out = {}
    for size, unit in sorted(units, key=lambda u: (-u[0], u[1])):
        total, shard = heapq.heappop(load)
        out[unit] = shard
        heapq.heappush(load, (total + size, shard))
    return out


def assign_shards(docs: DataFrame, n_shards: int = 8, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Every row with its shard and its slot in the shard.

    Added columns: `size` (UTF-8 bytes + 1; null text: 1), `text_crc32`
    (null text: that of no bytes), `shard` (0 to n_shards - 1) and `slot`
    (0, 1, ... without gaps in each shard, ascending `order`, nulls first;
    repeated values in any order). Only `order` and the added columns are
    returned. Null texts form one group, empty texts another. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    units = UNITS_PER_SHARD * n_shards
    rows = docs.select(
        F.col(order),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text).cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.sha2(F.col(text), 256), F.lit("null")).alias("_group"),
    )
    rows = rows.withColumn("_bundle", F.pmod(F.xxhash64("_group"), F.lit(units)))
    groups = rows.groupBy("_group", "_bundle").agg(F.sum("size").alias("_size"))
    total = groups.agg(F.sum("_size")).first()[0] or 0
    heavy = groups.filter(F.col("_size") * units > total).orderBy("_group").collect()  # fewer than `units`
    bundles = (groups.filter(F.col("_size") * units <= total)
               .groupBy("_bundle").agg(F.sum("_size").alias("_size")).collect())  # at most `units`
    shard_of = longest_first([(r["_size"], units + i) for i, r in enumerate(heavy)]
                             + [(r["_size"], r["_bundle"]) for r in bundles], n_shards)
    by_group = spark.createDataFrame([(r["_group"], shard_of[units + i]) for i, r in enumerate(heavy)],
                                     "_group string, _own int")
    by_bundle = spark.createDataFrame([(r["_bundle"], shard_of[r["_bundle"]]) for r in bundles],
                                      "_bundle long, _shared int")
    placed = (rows.join(F.broadcast(by_group), "_group", "left").join(F.broadcast(by_bundle), "_bundle", "left")
              .select(order, "size", "text_crc32", F.coalesce("_own", "_shared").alias("shard")))
    return _slots(placed, order)


def _slots(placed: DataFrame, order: str) -> DataFrame:
    ranged = (placed.repartitionByRange(F.col(order).asc_nulls_first())
              .sortWithinPartitions(F.col(order).asc_nulls_first())
              .withColumn("_part", F.spark_partition_id()))
    schema = ranged.withColumn("_local", F.lit(0).cast("long")).schema

    def number(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            local = []
            for s in batch.column("shard").to_pylist():
                local.append(seen.get(s, 0))
                seen[s] = local[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())],
                                             [*batch.schema.names, "_local"])

    numbered = written(ranged.mapInArrow(number, schema), "shards")
    counts = numbered.groupBy("_part", "shard").agg(F.count("*").alias("_n"))
    offsets = part_offsets(counts, ["_part", "shard"])
    return (numbered.join(F.broadcast(offsets), ["_part", "shard"])
            .select(order, "size", "text_crc32", "shard", (F.col("_before") + F.col("_local")).alias("slot")))
