"""Shared Spark helpers of the operators: tables, stage outputs, distributed order."""

from __future__ import annotations

import gc
import pathlib
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path


#: Bytes of an Arrow batch: a task holds one in the JVM and one in Python for every Python step in it.
BATCH_BYTES = 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that tasks can import it there, and
    bounds the session's Arrow batches where it has not set them itself lower than BATCH_BYTES."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(size).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_tidemart_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    # On the driver only: Spark serves the file to the executors from there.
    archive = pathlib.Path(tempfile.mkdtemp(prefix="tidemart-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._tidemart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: lineage ends here
    and any executor can read every part again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """A reliable checkpoint under `spark.checkpoint.dir`; removed with its reference where the session says so."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets the driver's JVM collect what a finished round has left, so that Spark's own cleaner removes its
    shuffle files and checkpoints now and not at some later time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ordered_ids(keys: DataFrame, key: str) -> DataFrame:
    """Distinct keys with their dense position `idx` in ascending order (nulls first).

    Keys are range-partitioned and sorted; a partition's rows are numbered in
    place and shifted by the row counts of the partitions before it. Only one
    count per partition meets in one place.
    """
    ranged = (keys.select(key).distinct().repartitionByRange(F.col(key).asc_nulls_first())
              .sortWithinPartitions(F.col(key).asc_nulls_first())
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = saved(ranged.select(key, F.shiftright("_at", 33).cast("int").alias("_part"),
                                 F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")))
    offsets = part_offsets(ranged.groupBy("_part").agg(F.count("*").alias("_n")), ["_part"])
    return (ranged.join(F.broadcast(offsets), "_part")
            .select(key, (F.col("_before") + F.col("_row")).alias("idx")))


def part_offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., `_n`) -> rows of the partitions before, `_before`, per other key.

    One row per partition and key meets in the window: bounded by the number
    of partitions, not by the rows.
    """
    others = [k for k in keys if k != "_part"]
    before = Window.partitionBy(*others).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
