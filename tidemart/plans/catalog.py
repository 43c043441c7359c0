"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Queries whose operator writes (partition replacement, merges, streaming
upserts) do so in catalog tables of their own, with folders under the shared
checkpoint location, and return what they read back.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods as pr
from ..operators.asof import asof_join
from ..operators.measures import sales_by_attributes, signed_daily_sum
from ..operators.merge import merge
from ..operators.quality import check_not_null, check_unique
from ..session import scratch_path
from ..sinks.tables import DayTable, HourTable, ImageTable, KeyTable, LoadRejected, create_view, stage_parquet, write_incremental
from ..sources import fixtures as fx
from ..sources.extract import extract_changes, extract_window
from ..sources.types import apply_type_policy
from ..streaming.upsert import ingest_staged, read_staged_stream, upsert_stream
from . import jobs, models
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def _days(start: str, end: str) -> list:
    """Every day of the half-open range ``[start, end)``."""
    first, last = pr.as_date(start), pr.as_date(end)
    return [first + pr.dt.timedelta(days=i) for i in range((last - first).days)]


def _view_name(name: str, sf: str) -> str:
    """A view of its own for each data folder."""
    return f"{name}_{zlib.crc32(sf.encode()):08x}"


def _own(kind: type, spark: SparkSession, name: str, *args, **kw):
    """A fresh table of the kind, under a name and in a folder of its own."""
    unique = f"{name}_{uuid.uuid4().hex[:12]}"
    return kind(spark, unique, scratch_path(spark, name), *args, **kw)


def _months(spark: SparkSession, name: str, day_source: str) -> DayTable:
    """A day table for days of a few rows, as the models' days are on this data: months share a partition."""
    return _own(DayTable, spark, name, day_source, granularity="month")


# ------------------------------------------------------------------ sources
def snapshot_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Full extract -> type policy -> staged -> main, read back."""
    main = _own(ImageTable, spark, "order_items_main")
    jobs.full_load(fx.order_items_source(spark, sf), scratch_path(spark, "snapshot"), main)
    return main.read()


def snapshot_extract_products(spark: SparkSession, sf: str) -> DataFrame:
    """The same load for the current image of ``products``, twice."""
    main = _own(KeyTable, spark, "products_main")
    for _ in range(2):
        jobs.full_load(fx.products_current(spark, sf), scratch_path(spark, "snapshot-products"), main)
    return main.read()


def hourly_change_load(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of several hours over order items, one of them twice."""
    staged, delta = _own(HourTable, spark, "items_staged"), _own(HourTable, spark, "items_delta")
    for run_time, hours in P.HOURLY_RUNS:
        jobs.hourly_change_load(fx.order_items_source(spark, sf), "created_at", run_time, staged, delta, hours)
    return delta.read()


def late_change_load(spark: SparkSession, sf: str) -> DataFrame:
    """S4/H9 with late commits: a fifth of the items becomes visible up to three hours after its stamp,
    and each run sees what is visible by then; one run is repeated."""
    items, delta = fx.order_items_source(spark, sf), _own(HourTable, spark, "late_delta")
    visible = F.col("created_at") + F.make_dt_interval(hours=F.when(F.col("id") % 5 == 0, F.col("id") % P.LATE_HOURS + 1).otherwise(0))
    for run_time in P.LATE_RUNS:
        seen = items.filter(visible <= fx.ntz(run_time))
        jobs.late_change_load(seen, "created_at", run_time, delta, hours=P.LATE_WINDOW, overlap=P.LATE_HOURS + 1)
    return delta.read()


def cdc_window_products(spark: SparkSession, sf: str) -> DataFrame:
    return extract_changes(fx.products_delta(spark, sf), "updated_at", *P.PRODUCT_CDC_WINDOW)


def cdc_window_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return extract_changes(fx.order_items_source(spark, sf), "created_at", *P.ORDER_CDC_WINDOW)


def hour_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """S5 for every event time taken as a run time."""
    ev = fx.events(spark, sf)
    return ev.select(
        "event_id", F.col("ts").alias("run_time"),
        pr.window_start_col("ts").alias("window_start"),
        pr.window_end_col("ts").alias("window_end"),
        pr.prefix_col(pr.window_start_col("ts")).alias("load_prefix"))


def source_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    """A declared source read through the catalog."""
    name = _view_name("order_items_delta", sf)
    create_view(fx.order_items_source(spark, sf), name)
    return spark.sql(f"SELECT * FROM {name}")


def type_policy(spark: SparkSession, sf: str) -> DataFrame:
    return apply_type_policy(fx.read_table(spark, sf, "lineitem"))


def view_filter(spark: SparkSession, sf: str) -> DataFrame:
    """W5 + F4: a view with a constant-equality filter."""
    items = fx.order_items_source(spark, sf)
    return create_view(items.filter(F.col("status") == P.RETURNED_STATUS), _view_name("returned_order_items", sf))


def select_except(spark: SparkSession, sf: str) -> DataFrame:
    return fx.order_items_source(spark, sf).drop("inventory_item_id", "status")


# ----------------------------------------------------------------- filters
def day_filter(spark: SparkSession, sf: str) -> DataFrame:
    return fx.order_items_source(spark, sf).filter(pr.day_equals("created_at", P.DAY))


def day_lower_bound(spark: SparkSession, sf: str) -> DataFrame:
    return fx.products_delta(spark, sf).filter(pr.day_at_least("updated_at", P.LOWER_DAY))


def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    delta = fx.products_delta(spark, sf)
    cases = [
        ("explicit", pr.scope_predicate("updated_at", day=P.SCOPE_DAY)),
        ("incremental", pr.scope_predicate("updated_at", incremental=True, as_of=P.SCOPE_AS_OF)),
        ("full", pr.scope_predicate("updated_at", first_day=P.SCOPE_FIRST_DAY)),
    ]
    parts = [delta.filter(pred).select(F.lit(name).alias("scope"), *models.DIMENSION_COLUMNS)
             for name, pred in cases]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def date_scalars(spark: SparkSession, sf: str) -> DataFrame:
    ev = fx.events(spark, sf)
    return ev.select(
        "event_id",
        pr.day_of("ts").alias("event_date"),
        F.date_sub(pr.day_of("ts"), 1).alias("prev_day"),
        pr.minus_days("ts", 1).alias("ts_minus_day"),
        pr.day_start("ts").alias("day_start"),
        *(pr.trunc_to(unit, "ts").alias(f"{unit}_trunc") for unit in ("year", "month", "day", "hour")),
        pr.day_of("ts").isin([pr.as_date(d) for d in P.DATE_LIST]).alias("in_days"),
        pr.format_day("ts").alias("day_str"))


# ------------------------------------------------------------------- joins
def _fact_and_dim(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    fact = models.sales_transaction_fact(fx.order_items_source(spark, sf))
    dim = models.product_dimension_daily(fx.products_delta(spark, sf))
    return fact, dim


def _asof(spark: SparkSession, sf: str, bucket: str) -> DataFrame:
    fact, dim = _fact_and_dim(spark, sf)
    return asof_join(fact, dim, fact_key="product_id", version_key="id",
                     fact_time="created_at", version_time="updated_at",
                     columns=models.REPORT_ATTRIBUTES, version_time_as="version_updated_at",
                     bucket=bucket)


def asof_join_month(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, "month")


def asof_join_union(spark: SparkSession, sf: str) -> DataFrame:
    """The same with buckets of one day: most matches come from earlier buckets."""
    return _asof(spark, sf, "day")


def asof_events(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase with the same user's last view at or before it."""
    ev = fx.events(spark, sf)
    purchases = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    views = ev.filter(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("view_event_id"))
    return asof_join(purchases, views, fact_key="user_id", version_key="user_id",
                     fact_time="ts", version_time="ts", columns=["view_event_id"],
                     version_time_as="view_ts")


def merge_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Source rows older than, as old as and newer than the target's, and new keys."""
    return merge(fx.products_image(spark, sf), fx.products_changes(spark, sf), key="id", version_col="updated_at")


def merge_unguarded(spark: SparkSession, sf: str) -> DataFrame:
    """The same data without the guard: older source rows win too."""
    return merge(fx.products_image(spark, sf), fx.products_changes(spark, sf), key="id")


# ------------------------------------------------------------ aggregation
def signed_daily_sum_q(spark: SparkSession, sf: str) -> DataFrame:
    return signed_daily_sum(models.sales_transaction_fact(fx.order_items_source(spark, sf)))


def sales_by_attributes_q(spark: SparkSession, sf: str) -> DataFrame:
    """A2 over sales enriched from the full version history (H2)."""
    fact = models.sales_transaction_fact(fx.order_items_source(spark, sf))
    history = models.product_history(fx.products_delta(spark, sf))
    sales = fact.select("product_id", "created_at", "sale_price")
    enriched = asof_join(sales, history, fact_key="product_id", version_key="id",
                         fact_time="created_at", version_time="updated_at",
                         columns=models.REPORT_ATTRIBUTES)
    return sales_by_attributes(enriched)


def latest_product_per_day(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.latest import keep_latest_per_day
    return keep_latest_per_day(fx.products_delta(spark, sf), "id", "updated_at")


def latest_order_item_per_day(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.latest import keep_latest_per_day
    return keep_latest_per_day(fx.order_items_source(spark, sf), "id", "created_at")


def limit_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """L1: the top rows by a total order (top-k per task, then merged)."""
    items = fx.order_items_source(spark, sf)
    return items.orderBy(*[F.col(c).asc_nulls_last() for c in fx.ORDER_ITEM_COLUMNS]).limit(P.LIMIT_ROWS)


# ------------------------------------------------------- partition writes
def _items_table(spark: SparkSession, sf: str, name: str, deduped: bool) -> DayTable:
    items = fx.order_items_source(spark, sf)
    table = _own(DayTable, spark, name, "created_at")
    write_incremental(table, models.sales_transaction_fact(items) if deduped else items, sort_key="id")
    return table


def delete_day(spark: SparkSession, sf: str) -> DataFrame:
    table = _items_table(spark, sf, "delete_day", deduped=True)
    table.delete_days([P.DAY])
    return table.read()


def reload_day(spark: SparkSession, sf: str) -> DataFrame:
    """W9 on raw items: the day is reloaded from the fact query, twice."""
    table = _items_table(spark, sf, "reload_day", deduped=False)
    items = fx.order_items_source(spark, sf)
    for _ in range(2):  # idempotent: a second run leaves the same table
        table.reload_day(models.sales_transaction_fact(items, [P.DAY]), P.DAY, sort_key="id")
    return table.read()


def replace_partitions(spark: SparkSession, sf: str) -> DataFrame:
    table = _items_table(spark, sf, "replace", deduped=False)
    days = _days(*P.REPLACE_DAYS)
    items = fx.order_items_source(spark, sf)
    table.replace_days(models.sales_transaction_fact(items, days), days, sort_key="id")
    return table.read()


def replace_partitions_empty(spark: SparkSession, sf: str) -> DataFrame:
    """W10 when the delta was truncated to its last hour: the listed days
    have no source rows and must disappear."""
    table = _items_table(spark, sf, "replace_empty", deduped=True)
    days = _days(*P.EMPTY_DAYS)
    truncated = extract_window(fx.order_items_source(spark, sf), "created_at",
                               *P.TRUNCATED_DELTA_WINDOW)
    table.replace_days(models.sales_transaction_fact(truncated, days), days, sort_key="id")
    return table.read()


def checked_load(spark: SparkSession, sf: str) -> DataFrame:
    """Q1/Q2 along with the load: the fact's ids have to be unique a day and its stamps not null. Raw items,
    in which ids repeat, are refused and change nothing; the deduplicated days are taken."""
    table = _own(DayTable, spark, "checked", "created_at", granularity="month")
    table.checks = {"unique id a day": lambda df: check_unique(df.withColumn("key", F.struct("id", pr.day_of("created_at"))), "key"),
                    "created_at not null": lambda df: check_not_null(df, "created_at")}
    items, days = fx.order_items_source(spark, sf), _days(*P.CHECKED_DAYS)
    table.create(models.sales_transaction_fact(items))
    changed = items.withColumn("sale_price", F.col("sale_price") * 2)
    for rows in (changed.unionByName(items), models.sales_transaction_fact(items, days).withColumn("sale_price", (F.col("sale_price") + 1).cast("decimal(18,2)"))):
        try:
            table.replace_days(rows, days, sort_key="id")
        except LoadRejected:
            pass
    return table.read()


# ------------------------------------------------------------- pipelines
def product_dim_scd1(spark: SparkSession, sf: str) -> DataFrame:
    """H1: dimension from one image of the products, then the rows that a
    second image changed on the merge days, merged in with the guard."""
    dim = _own(KeyTable, spark, "scd1")
    jobs.run_product_dim_scd1(dim, fx.products_image(spark, sf), None)
    start, end = P.PRODUCT_CDC_WINDOW
    jobs.run_product_dim_scd1(dim, fx.products_changes(spark, sf), _days(start[:10], end[:10]))
    return dim.read()


def product_dim_scd1_scoped(spark: SparkSession, sf: str) -> DataFrame:
    """H4: first build since the first day, then listed days and yesterday, unguarded."""
    dim = _own(KeyTable, spark, "scd1_scoped")
    jobs.run_product_dim_scd1_scoped(dim, fx.products_image(spark, sf), first_day=P.SCD_FIRST_DAY)
    changes = fx.products_changes(spark, sf)
    start, end = P.UNGUARDED_WINDOW
    jobs.run_product_dim_scd1_scoped(dim, changes, day=_days(start[:10], end[:10]))
    jobs.run_product_dim_scd1_scoped(dim, changes, as_of=P.SCD_AS_OF)
    return dim.read()


def product_dim_history(spark: SparkSession, sf: str) -> DataFrame:
    """H2: first run copies the delta before the cut, later runs add the
    merge window's days (one replace of those days)."""
    delta = fx.products_delta(spark, sf)
    table = _months(spark, "history", "updated_at")
    jobs.run_product_history(table, delta.filter(F.col("updated_at") < fx.ntz(fx.MAIN_CUTOFF)))
    return jobs.run_product_history(table, delta, _days(fx.MAIN_CUTOFF[:10], P.HISTORY_END)).read()


def product_dim_daily(spark: SparkSession, sf: str) -> DataFrame:
    """H3: first run before the cut, then the later days replaced."""
    delta = fx.products_delta(spark, sf)
    table = _months(spark, "dim_daily", "updated_at")
    jobs.run_product_dimension_daily(table, delta.filter(F.col("updated_at") < fx.ntz(fx.MAIN_CUTOFF)))
    return jobs.run_product_dimension_daily(table, delta, _days(fx.MAIN_CUTOFF[:10], P.HISTORY_END)).read()


def product_intervals_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """H2 + H11: intervals built from the middle of the history, then the later days, then the earlier
    ones, which split intervals, and one part again."""
    delta = fx.products_delta(spark, sf)
    table = _own(KeyTable, spark, "intervals")
    first, second = P.INTERVAL_CUTS
    jobs.run_product_intervals(table, delta, _days(first, second))
    for days in (_days(second, P.HISTORY_END), _days(P.HISTORY_START, first), _days(first, second)):
        jobs.run_product_intervals(table, delta, days)
    return table.read()


def product_dim_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return models.product_intervals(models.product_dimension_daily(fx.products_delta(spark, sf)))


def sales_transaction_fact(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.run_sales_transaction_fact(_own(DayTable, spark, "fact", "created_at"), fx.order_items_source(spark, sf)).read()


def sales_periodic_fact(spark: SparkSession, sf: str) -> DataFrame:
    fact = jobs.run_sales_transaction_fact(_months(spark, "fact", "created_at"), fx.order_items_source(spark, sf))
    return jobs.run_sales_periodic_fact(_months(spark, "periodic", "transaction_date"), fact).read()


def sales_report(spark: SparkSession, sf: str) -> DataFrame:
    """H7, the flagship: all days, as a DataFrame."""
    fact, dim = _fact_and_dim(spark, sf)
    return models.sales_report(fact, dim)


def sales_report_daily(spark: SparkSession, sf: str) -> DataFrame:
    """H7 as scheduled: written fact and dimension in, report days out; two days' runs repeated."""
    fact = jobs.run_sales_transaction_fact(_months(spark, "fact", "created_at"), fx.order_items_source(spark, sf))
    dim = jobs.run_product_dimension_daily(_months(spark, "dim_daily", "updated_at"), fx.products_delta(spark, sf))
    report = _months(spark, "report", "transaction_date")
    jobs.run_sales_report(report, fact, dim.read())
    for _ in range(2):
        jobs.run_sales_report(report, fact, dim.read(), list(P.REPORT_DAYS))
    return report.read()


def merge_delta_to_main(spark: SparkSession, sf: str) -> DataFrame:
    """H8: the window's newest changes; some are older than the main table's rows."""
    main = _own(KeyTable, spark, "main")
    main.create(fx.products_image(spark, sf))
    jobs.run_merge_delta_to_main(main, fx.products_delta(spark, sf), window=P.PRODUCT_CDC_WINDOW)
    return main.read()


# ------------------------------------------------------------------ checks
def check_unique_q(spark: SparkSession, sf: str) -> DataFrame:
    return check_unique(fx.order_items_source(spark, sf), "id")


def check_not_null_q(spark: SparkSession, sf: str) -> DataFrame:
    return check_not_null(fx.order_items_source(spark, sf), "shipped_at")


# --------------------------------------------------------------- streaming
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Staged files appended once each, though the stream is run again after more have come."""
    root = scratch_path(spark, "ingest")
    delta = fx.products_delta(spark, sf)
    early = F.col("updated_at") < fx.ntz(fx.MAIN_CUTOFF)
    for part in (delta.filter(early), delta.filter(~early)):
        stage_parquet(part, f"{root}/staged", mode="append")
        ingest_staged(spark, f"{root}/staged", delta.schema, f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(delta.schema).parquet(f"{root}/sink")


def stream_upsert_final(spark: SparkSession, sf: str) -> DataFrame:
    """T1 + T2: the change feed staged in two deliveries, the newer rows first, and streamed into a
    keep-latest upsert; the newest stamp of every key is the stream's state. The first delivery comes
    again with the second one, whose rows are late."""
    root = scratch_path(spark, "stream")
    delta = fx.products_delta(spark, sf)
    target = _own(KeyTable, spark, "upserted")
    early = F.col("updated_at") < fx.ntz(P.LATE_BEFORE)
    for part in (delta.filter(~early), delta):
        stage_parquet(part, f"{root}/staged", mode="append")
        stream = read_staged_stream(spark, f"{root}/staged", delta.schema)
        upsert_stream(stream, target, "updated_at", f"{root}/checkpoint").awaitTermination()
    return target.read()


def queries() -> dict[str, Query]:
    return {
        "sales_report": sales_report,
        "snapshot_extract": snapshot_extract,
        "snapshot_extract_products": snapshot_extract_products,
        "hourly_change_load": hourly_change_load,
        "late_change_load": late_change_load,
        "sales_report_daily": sales_report_daily,
        "stream_ingest": stream_ingest,
        "cdc_window_products": cdc_window_products,
        "cdc_window_order_items": cdc_window_order_items,
        "hour_bucket": hour_bucket,
        "source_passthrough": source_passthrough,
        "type_policy": type_policy,
        "view_filter": view_filter,
        "delete_day": delete_day,
        "reload_day": reload_day,
        "replace_partitions": replace_partitions,
        "replace_partitions_empty": replace_partitions_empty,
        "select_except": select_except,
        "day_filter": day_filter,
        "day_lower_bound": day_lower_bound,
        "scope_filter": scope_filter,
        "asof_join": asof_join_month,
        "asof_join_union": asof_join_union,
        "asof_events": asof_events,
        "merge_guarded": merge_guarded,
        "merge_unguarded": merge_unguarded,
        "signed_daily_sum": signed_daily_sum_q,
        "sales_by_attributes": sales_by_attributes_q,
        "latest_product_per_day": latest_product_per_day,
        "latest_order_item_per_day": latest_order_item_per_day,
        "limit_ordered": limit_ordered,
        "product_dim_scd1": product_dim_scd1,
        "product_dim_history": product_dim_history,
        "product_dim_daily": product_dim_daily,
        "product_dim_scd1_scoped": product_dim_scd1_scoped,
        "sales_transaction_fact": sales_transaction_fact,
        "sales_periodic_fact": sales_periodic_fact,
        "merge_delta_to_main": merge_delta_to_main,
        "product_dim_intervals": product_dim_intervals,
        "product_intervals_incremental": product_intervals_incremental,
        "checked_load": checked_load,
        "check_unique": check_unique_q,
        "check_not_null": check_not_null_q,
        "stream_upsert_final": stream_upsert_final,
        "date_scalars": date_scalars,
    }
