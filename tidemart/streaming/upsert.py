"""Micro-batch change data capture with Structured Streaming.

* ``ingest_staged`` (T1): staged Parquet extracts are picked up incrementally,
  each file exactly once (the file source's log in the checkpoint), and
  appended to a sink laid out by window keys.
* ``upsert_stream`` (T2): the stream's state holds the newest row of every
  key, so a micro-batch gives out only rows that are newer than all before
  them: late and repeated rows are dropped without a look at the target. What
  is left is merged into a ``KeyTable`` with the version guard, which rewrites
  only the buckets it touches. A batch that is run again after a lost driver
  finds its rows there and changes nothing; the number of the last batch is
  kept as a table property, so that rows without a key are not added twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import latest_per_key
from ..sinks.tables import KeyTable

#: Table property with the number of the last batch merged.
LAST_BATCH = "tidemart.last_batch"


def read_staged_stream(spark: SparkSession, path: str, schema: T.StructType,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def ingest_staged(spark: SparkSession, path: str, schema: T.StructType, sink_path: str,
                  checkpoint: str, partition_by: Sequence[str] | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append every new staged file to ``sink_path`` (available-now run)."""
    stream = read_staged_stream(spark, path, schema, max_files_per_trigger)
    writer = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(sink_path)


def newest_rows(stream: DataFrame, key: str, version_col: str) -> DataFrame:
    """Per micro-batch, the rows that become the newest of their key; rows without a key pass.

    A streaming aggregate keeps the newest row of every key with the time of
    the batch that brought it (the batch's own, which a rerun repeats). Of a
    batch's keys, those whose newest row came just now are given out. Of equal
    stamps the first to come stays; within a batch the largest by the other
    columns wins. Rows are reduced to one per key and task before the shuffle.
    """
    others = [c for c in stream.columns if c not in (key, version_col)]
    timed = stream.withColumn("__at", F.unix_micros(F.current_timestamp()))
    order = F.struct(F.col(version_col).isNotNull(), version_col, -F.col("__at"), *others)
    newest = (timed.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
              .agg(F.max_by(F.struct(*stream.columns, "__at"), order).alias("__row"), F.max("__at").alias("__last"))
              .filter(F.col("__row.__at") == F.col("__last")).select(*[F.col(f"__row.{c}").alias(c) for c in stream.columns]))
    return newest.unionByName(stream.filter(F.col(key).isNull()))


def upsert_batch(batch: DataFrame, batch_id: int, target: KeyTable, version_col: str) -> dict[str, list[int]] | None:
    """Merge one micro-batch; the buckets it changed (None if it was merged before)."""
    spark = target.spark
    if target.exists():
        row = spark.sql(f"SHOW TBLPROPERTIES {target.name}").filter(F.col("key") == LAST_BATCH).first()
        if row is not None and int(row["value"]) >= batch_id:
            return None
    changed = target.merge(latest_per_key(batch, target.key, version_col), version_col=version_col)
    spark.sql(f"ALTER TABLE {target.name} SET TBLPROPERTIES ('{LAST_BATCH}' = '{batch_id}')")
    return changed


def upsert_stream(stream: DataFrame, target: KeyTable, version_col: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep-latest upsert of a change stream into ``target``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, target, version_col)

    writer = (newest_rows(stream, target.key, version_col).writeStream.outputMode("update")
              .foreachBatch(handle).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
