"""Reading the source system: full snapshots and change windows.

* JDBC (S1-S4): a partitioned scan -- ``partitionColumn``/bounds split the
  table into ``numPartitions`` range queries that executors run in parallel,
  and window predicates are pushed into each query's WHERE clause.
* Change window (S3/S4): half-open ``[start, end)`` on the change column;
  ``tag_windows`` adds the window keys (``load_date``, ``load_hour``) each row
  belongs to, so one job can back-fill many hourly windows at once.
* Staged Parquet (S6), seeds (S8) and literal rows (S9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import format_day, format_time, hour_of, in_window

LOAD_DATE = "load_date"
LOAD_HOUR = "load_hour"


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Snapshot scan of a database table.

    With ``partition_column`` (numeric, date or timestamp) the scan is split
    into ``num_partitions`` parallel range queries; the bounds only decide the
    split, every row is read. Missing bounds are fetched with one
    ``MIN``/``MAX`` query that the database answers.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if not num_partitions:
            raise ValueError("partitioned JDBC scan needs num_partitions")
        if lower_bound is None or upper_bound is None:
            lo, hi = jdbc_bounds(spark, url, table, partition_column, properties)
            if lo is None:  # empty table: one partition reads it
                return read_jdbc(spark, url, table, properties=properties, fetch_size=fetch_size)
            lower_bound = lo if lower_bound is None else lower_bound
            upper_bound = hi if upper_bound is None else upper_bound
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: dict | None = None) -> tuple:
    """``(MIN(column), MAX(column))`` of a table, computed by the database."""
    reader = spark.read.format("jdbc").option("url", url).option(
        "query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    row = reader.load().first()
    return (row["LO"] if "LO" in row else row["lo"]), (row["HI"] if "HI" in row else row["hi"])


def extract_window(source: DataFrame, change_column: str, start, end,
                   kind: str = "timestamp_ntz") -> DataFrame:
    """Rows whose change column is in ``[start, end)``."""
    return source.filter(in_window(change_column, start, end, kind))


def tag_windows(df: DataFrame, change_column: str) -> DataFrame:
    """Add the hourly window keys the row belongs to (its hour's start)."""
    start = hour_of(change_column)
    return (df.withColumn(LOAD_DATE, format_day(start))
              .withColumn(LOAD_HOUR, format_time(start)))


def extract_changes(source: DataFrame, change_column: str, start, end,
                    kind: str = "timestamp_ntz") -> DataFrame:
    """Change extract of ``[start, end)`` with its window keys."""
    return tag_windows(extract_window(source, change_column, start, end, kind), change_column)


def read_staged(spark: SparkSession, path: str, schema: T.StructType | None = None,
                load_date: str | None = None, load_hour: str | None = None) -> DataFrame:
    """Read staged Parquet (S6); window keys prune the partition folders.

    Pass the staged schema (window keys as strings): inferred from folder
    names, ``load_hour=09:00:00`` would be typed as TIME, which Spark cannot
    read.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if load_date is not None:
        df = df.filter(F.col(LOAD_DATE) == load_date)
    if load_hour is not None:
        df = df.filter(F.col(LOAD_HOUR) == load_hour)
    return df


# Typed schema of the province seed.
PROVINCES_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("iso2", T.StringType()),
    T.StructField("admin_name", T.StringType()),
    T.StructField("capital", T.StringType()),
    T.StructField("population", T.LongType()),
    T.StructField("population_proper", T.LongType()),
])


def read_seed(spark: SparkSession, path: str, schema: T.StructType = PROVINCES_SCHEMA) -> DataFrame:
    """CSV seed with header and an explicit schema (no inference pass)."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def literal_rows(spark: SparkSession, values: Sequence, name: str = "id",
                 dtype: str = "bigint") -> DataFrame:
    """``SELECT v1 AS id UNION ALL SELECT v2 ...`` (S9 + U1)."""
    parts = [spark.createDataFrame([(v,)], f"{name} {dtype}") for v in values]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
