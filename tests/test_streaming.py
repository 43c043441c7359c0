import datetime as dt
import uuid

from core_data import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemart.operators.latest import keep_latest
from tidemart.session import scratch_path
from tidemart.sinks.tables import KeyTable, stage_parquet
from tidemart.sources import fixtures as fx
from tidemart.streaming.upsert import ingest_staged, newest_rows, read_staged_stream, upsert_batch, upsert_stream

T = dt.datetime


def test_ingest_each_file_once(spark):
    root = scratch_path(spark, "t1")
    df = spark.range(30).selectExpr("id", "'2020-01-01' AS load_date")
    stage_parquet(df.repartition(3), f"{root}/staged")
    for _ in range(2):  # second run finds no new file
        ingest_staged(spark, f"{root}/staged", df.schema, f"{root}/sink", f"{root}/ckpt",
                      partition_by=["load_date"]).awaitTermination()
    assert spark.read.parquet(f"{root}/sink").count() == 30
    stage_parquet(spark.range(30, 35).selectExpr("id", "'2020-01-02' AS load_date"),
                  f"{root}/staged", mode="append")
    ingest_staged(spark, f"{root}/staged", df.schema, f"{root}/sink", f"{root}/ckpt",
                  partition_by=["load_date"]).awaitTermination()
    assert spark.read.parquet(f"{root}/sink").count() == 35


def _target(spark):
    name = f"tm_{uuid.uuid4().hex[:12]}"
    return KeyTable(spark, name, scratch_path(spark, name), buckets=4)


def test_stream_upsert_equals_batch_with_late_and_replayed_files(spark):
    root, target = scratch_path(spark, "t2"), _target(spark)
    delta = fx.products_delta(spark, SF_SMALL)
    stage_parquet(delta.repartitionByRange(4, F.col("updated_at").desc()), f"{root}/staged")  # newest files first
    expected = keep_latest(delta, ["id"], "updated_at")
    for _ in range(2):
        stream = read_staged_stream(spark, f"{root}/staged", delta.schema, max_files_per_trigger=1)
        upsert_stream(stream, target, "updated_at", f"{root}/ckpt").awaitTermination()
        assert rows(target.read()) == rows(expected.select(*target.read().columns))
        stage_parquet(delta.limit(200), f"{root}/staged", mode="append")  # rows that came before, in a new file


def test_late_and_repeated_rows_are_dropped_by_the_state(spark):
    """What a batch gives out is judged by the stream's state alone: the target is not asked."""
    root = scratch_path(spark, "t2-state")
    schema = "id long, updated_at timestamp_ntz, v string"
    batches = [[(1, T(2020, 1, 5), "a"), (1, T(2020, 1, 6), "b"), (2, T(2020, 1, 1), "x"), (None, T(2020, 1, 1), "n")],
               [(1, T(2020, 1, 2), "late"), (2, T(2020, 1, 1), "same stamp"), (3, T(2020, 1, 1), "new")],
               [(1, T(2020, 1, 7), "c"), (2, T(2020, 1, 1), "x"), (3, None, "no stamp")]]
    given = []
    for i, data in enumerate(batches):
        stage_parquet(spark.createDataFrame(data, schema).coalesce(1), f"{root}/staged", mode="append")
        stream = newest_rows(read_staged_stream(spark, f"{root}/staged", spark.createDataFrame([], schema).schema), "id", "updated_at")
        query = (stream.writeStream.outputMode("update").foreachBatch(lambda b, n: given.append(sorted((r["id"], r["v"]) for r in b.collect() if r["id"])))
                 .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        query.awaitTermination()
    assert given == [[(1, "b"), (2, "x")], [(3, "new")], [(1, "c")]]


def test_replayed_batch_is_skipped(spark):
    target = _target(spark)
    schema = "id long, updated_at timestamp_ntz, v string"
    batch = spark.createDataFrame([(1, T(2020, 1, 1), "a"), (None, T(2020, 1, 1), "n")], schema)
    upsert_batch(batch, 0, target, "updated_at")
    later = spark.createDataFrame([(1, T(2020, 1, 2), "b")], schema)
    assert len(upsert_batch(later, 1, target, "updated_at")["rewritten"]) == 1
    assert upsert_batch(batch, 1, target, "updated_at") is None   # replay of batch 1
    older = spark.createDataFrame([(1, T(2019, 1, 1), "old")], schema)
    assert upsert_batch(older, 2, target, "updated_at") == {"rewritten": [], "appended": []}  # late row loses
    assert rows(target.read(), "id", "v") == [(None, "n"), (1, "b")]
