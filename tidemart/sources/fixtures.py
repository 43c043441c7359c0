"""Source tables of the pipeline, derived from the driver's parquet tables.

The pipeline is specified on two OLTP tables (``products`` and
``order_items``) and their change feeds. The test data ships TPC-H-like
tables instead, so these functions derive the same shapes with plain
DataFrame expressions. All of it is narrow column work except one equi join
(lineitem to orders on the order key); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.latest import keep_latest

# Fixed values of the fixture mapping (they decide which rows exist and
# must be equal in the DuckDB oracle): hash multipliers for the sale second
# of day, the product-change day spread, and the window cut days.
SALE_SECOND_MULTIPLIERS = (7919, 104729, 15485)  # l_partkey, l_suppkey, l_linenumber
SECONDS_PER_DAY = 86400
CHANGE_DAY_MULTIPLIERS = (131, 797)  # p_partkey, change number % 3
CHANGE_DAY_SPREAD = 2400
CHANGE_HOUR_STEP = 5
CHANGES_PER_PRODUCT = 4
BRAND_COUNT = 25
FIRST_CHANGE_DAY = "1995-01-01 00:00:00"
MAIN_CUTOFF = "1996-06-01 00:00:00"

ORDER_ITEM_COLUMNS = [
    "id", "order_id", "user_id", "product_id", "inventory_item_id", "status",
    "created_at", "shipped_at", "delivered_at", "returned_at", "sale_price",
]
PRODUCT_COLUMNS = [
    "id", "cost", "category", "name", "brand", "retail_price", "department",
    "sku", "distribution_center_id", "updated_at",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(literal: str) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock UTC, no session zone applied)."""
    return F.lit(literal).cast("timestamp_ntz")


def order_items_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``order_items`` table: every line item becomes one sale.

    ``id`` repeats (the order/line key of the test data is not unique), which
    is what makes keep-latest a real operation downstream.
    """
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    m_part, m_supp, m_line = SALE_SECOND_MULTIPLIERS
    second_of_day = (F.col("l_partkey") * m_part + F.col("l_suppkey") * m_supp
                     + F.col("l_linenumber") * m_line) % SECONDS_PER_DAY
    created = F.timestamp_add("SECOND", second_of_day, F.col("l_shipdate"))
    returned = F.col("l_returnflag") == "R"
    shipped = (F.col("l_linestatus") == "F") | returned
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return (joined
            .withColumn("created_at", created)
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_suppkey").alias("inventory_item_id"),
                F.when(returned, "Returned")
                 .when(F.col("l_linestatus") == "F", "Complete")
                 .otherwise("Processing").alias("status"),
                F.col("created_at"),
                F.when(shipped, F.timestamp_add("DAY", F.lit(1), "created_at")).alias("shipped_at"),
                F.when(shipped, F.timestamp_add("DAY", F.lit(4), "created_at")).alias("delivered_at"),
                F.when(returned, F.timestamp_add("DAY", F.lit(14), "created_at")).alias("returned_at"),
                F.col("l_extendedprice").cast("decimal(18,2)").alias("sale_price"),
            ))


def products_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``products`` change feed: four versions of every part.

    The versions come from exploding a fixed 4-element array (no join), so the
    work is one pass over ``part``, dealt out while its rows are narrow. Change 3 falls on the same day as
    change 0, a few hours later.
    """
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_retailprice")
    # a file that one task reads holds millions of parts: their versions are made, and sorted later, by many tasks
    part = part.repartition(*part.columns)
    versions = F.explode(F.array(*[F.lit(v).cast("long") for v in range(CHANGES_PER_PRODUCT)]))
    m_key, m_version = CHANGE_DAY_MULTIPLIERS
    key = F.col("p_partkey")
    v = F.col("v")
    day_offset = (key * m_key + (v % 3) * m_version) % CHANGE_DAY_SPREAD
    updated = F.timestamp_add(
        "HOUR", v * CHANGE_HOUR_STEP,
        F.timestamp_add("DAY", day_offset, ntz(FIRST_CHANGE_DAY)))
    return (part.select("*", versions.alias("v"))
            .select(
                key.alias("id"),
                (F.col("p_retailprice") * 0.5).alias("cost"),
                F.col("p_type").alias("category"),
                F.col("p_name").alias("name"),
                F.concat(F.lit("Brand#"), ((key + 7 * v) % BRAND_COUNT).cast("string")).alias("brand"),
                F.col("p_retailprice").alias("retail_price"),
                F.when((key + v) % 2 == 0, "Women").otherwise("Men").alias("department"),
                F.concat(F.lit("SKU"), key.cast("string")).alias("sku"),
                (key % 10 + 1).alias("distribution_center_id"),
                updated.alias("updated_at"),
            ))


def products_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current image of ``products`` as of the main cut-off (one row per id)."""
    delta = products_delta(spark, sf_dir).filter(F.col("updated_at") < ntz(MAIN_CUTOFF))
    return keep_latest(delta, ["id"], "updated_at")


def products_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``products`` table itself: the newest version of every product."""
    return keep_latest(products_delta(spark, sf_dir), ["id"], "updated_at")


def _nth_version(spark: SparkSession, sf_dir: str, nth: Column) -> DataFrame:
    """Of every product the version with that number in time (1 to 4)."""
    by_time = Window.partitionBy("id").orderBy("updated_at")
    ranked = products_delta(spark, sf_dir).withColumn("nth", F.row_number().over(by_time))
    return ranked.filter(F.col("nth") == nth).drop("nth")


def products_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version of nine products in ten, taken from the whole feed: merge targets."""
    return _nth_version(spark, sf_dir, F.floor(F.col("id") / 4) % 4 + 1).filter(F.col("id") % 10 != 0)


def products_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version of every product: against ``products_image`` older, the same, newer, or a new key."""
    return _nth_version(spark, sf_dir, F.col("id") % 4 + 1)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")
