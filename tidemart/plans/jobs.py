"""Model runs with their materialization (the scheduled daily and hourly jobs).

Each job decides bootstrap-or-incremental by looking its target up in the
catalog (W11), builds the model with ``tidemart.plans.models`` and writes it:

* day-partitioned models (H2, H3, H5, H6, H7) replace their listed days;
* current images (H1, H4, H8) are tables in hash buckets of the key; a merge
  rewrites only the buckets in which a row changes;
* version intervals (H11) are kept in such buckets too: changed keys alone are
  cut anew;
* extract loads (H9, H10) stage Parquet, then replace the delta's hours or the
  main table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import change_window, window_prefix
from ..sinks.tables import BUCKET_COLUMN, DayTable, HourTable, ImageTable, KeyTable, stage_parquet, stored_once, write_incremental
from ..sources.extract import extract_changes, read_staged
from ..sources.types import apply_type_policy
from . import models


# ------------------------------------------------------------------ H9, H10
def full_load(source: DataFrame, staging_path: str, main: ImageTable | KeyTable,
              max_records_per_file: int | None = None) -> None:
    """Snapshot -> type policy -> staged Parquet -> replace main."""
    typed = apply_type_policy(source)
    stage_parquet(typed, staging_path, max_records_per_file=max_records_per_file)
    staged = read_staged(source.sparkSession, staging_path, schema=typed.schema)
    if isinstance(main, KeyTable):
        main.create(staged)
    else:
        main.replace(staged)


def hourly_change_load(source: DataFrame, change_column: str, run_time, staged: HourTable, delta: HourTable,
                       hours: int = 1, replace: bool = False, max_records_per_file: int | None = None) -> list[str]:
    """H9: window of the run -> type policy -> the window's hours of the staged table -> the
    same hours of the delta. Returns the window's hours.

    The window's hours are replaced in both tables, so a rerun leaves the same
    rows, and an hour without rows disappears. The delta keeps its other
    hours; ``replace=True`` is the form that holds only the last window.
    """
    start, end = change_window(run_time, hours)
    changes = apply_type_policy(extract_changes(source, change_column, start, end))
    prefixes = [window_prefix(start + dt.timedelta(hours=h)) for h in range(hours)]
    window = {tuple(p.split("/")) for p in prefixes}
    staged.replace_hours(changes, window, max_records_per_file)
    rows = staged.spark.table(staged.name).filter(F.struct(*staged.columns).isin([F.struct(F.lit(d), F.lit(h)) for d, h in sorted(window)]))
    delta.replace_hours(rows, (delta.hours() if replace else set()) | window, max_records_per_file)
    return prefixes


def late_change_load(source: DataFrame, change_column: str, run_time, delta: HourTable,
                     hours: int = 1, overlap: int = 2) -> list[str]:
    """H9 for sources in which a row becomes visible up to ``overlap`` hours after its stamp.

    A run reads its window and the ``overlap`` hours before it again, takes
    away the rows that the delta's same hours hold (the ledger: bounded by the
    hours read, whatever the delta's size), and appends what is left to the
    hours of the rows' stamps. So a row that is committed after its window has
    been loaded comes with a later run, none is loaded twice by a rerun, rows
    that repeat in the source are kept as often as they are there, and a
    version that the source has overwritten since stays in the delta. Returns
    the hours read.
    """
    start, end = change_window(run_time, hours)
    first = start - dt.timedelta(hours=overlap)
    changes = apply_type_policy(extract_changes(source, change_column, first, end))
    prefixes = [window_prefix(first + dt.timedelta(hours=h)) for h in range(hours + overlap)]
    if not delta.exists():
        delta.replace_hours(changes, ())
        return prefixes
    hour = F.struct(*delta.columns).isin([F.struct(*map(F.lit, p.split("/"))) for p in prefixes])
    held = delta.spark.table(delta.name).filter(hour)
    with stored_once(changes.select(*held.columns).exceptAll(held), "late-rows", delta.spark) as fresh:
        fresh.write.insertInto(delta.name)
    return prefixes


# ---------------------------------------------------------- day partitioned
def run_sales_transaction_fact(table: DayTable, order_items: DataFrame, days=None) -> DayTable:
    """H5: newest item version per day, listed days replaced."""
    write_incremental(table, models.sales_transaction_fact(order_items, days), days, sort_key="id")
    return table


def _fact_rows(fact: DataFrame | DayTable, days) -> DataFrame:
    """Fact rows of the listed days; a ``DayTable`` prunes its partitions
    (a filter on ``created_at`` alone cannot prune the derived ``dt``)."""
    if isinstance(fact, DayTable):
        return fact.read(days=days)
    return fact


def run_sales_periodic_fact(table: DayTable, fact: DataFrame | DayTable, days=None) -> DayTable:
    """H6: signed daily totals, listed days replaced."""
    write_incremental(table, models.sales_periodic_fact(_fact_rows(fact, days), days), days)
    return table


def run_product_dimension_daily(table: DayTable, products_delta: DataFrame, days=None) -> DayTable:
    """H3: newest product version per day, listed days replaced."""
    write_incremental(table, models.product_dimension_daily(products_delta, days), days, sort_key="id")
    return table


def run_product_history(table: DayTable, products_delta: DataFrame, days=None) -> DayTable:
    """H2: first run copies the delta; later runs add the listed days'
    versions (re-running a day replaces it, so appends are idempotent)."""
    if not table.exists():
        table.create(models.product_history(products_delta), sort_key="id")
    else:
        table.replace_days(models.product_history(products_delta, days), days, sort_key="id")
    return table


def run_sales_report(table: DayTable, fact: DataFrame | DayTable, product_dim: DataFrame, days=None) -> DayTable:
    """H7: report rows of the listed days replaced."""
    write_incremental(table, models.sales_report(_fact_rows(fact, days), product_dim, days), days)
    return table


# ---------------------------------------------------------- current images
def run_merge_delta_to_main(main: KeyTable, delta: DataFrame, days=None, window=None) -> dict[str, list[int]]:
    """H8: guarded merge of the day's newest changes into the main table."""
    return main.merge(models.newest_changes(delta, days, window, main.key), version_col="updated_at")


def run_product_dim_scd1(dim: KeyTable, products_main: DataFrame, days) -> dict[str, list[int]]:
    """H1: create from the main table, else guarded merge of the day's rows."""
    if not dim.exists():
        dim.create(products_main.select(*models.DIMENSION_COLUMNS))
        return {"rewritten": list(range(dim.buckets)), "appended": []}
    return dim.merge(models.product_dim_scd1_source(products_main, days), version_col="updated_at")


def run_product_dim_scd1_scoped(dim: KeyTable, products_main: DataFrame, day=None,
                                as_of=None, first_day="2022-01-01") -> dict[str, list[int]]:
    """H4: unguarded merge with the explicit / yesterday / first-build scope."""
    return dim.merge(models.product_dim_scoped_source(products_main, day=day, incremental=dim.exists(), as_of=as_of, first_day=first_day))


# ------------------------------------------------------- type 2 with intervals
def run_product_intervals(table: KeyTable, products_delta: DataFrame, days=None) -> list[int]:
    """H2 + H11 kept up to date: the listed days' versions are put among the intervals of their keys.

    A newer version ends its key's open interval and opens another; a late one
    splits the interval it falls in; a version that is there already changes
    nothing. Only the intervals of keys with versions in the listed days are
    cut anew, and only buckets in which an interval changes are rewritten, so
    days may come in any order and may be run again. Returns those buckets.
    """
    key = table.key
    versions = models.product_history(products_delta, days).filter(F.col(key).isNotNull() & F.col("updated_at").isNotNull())
    if not table.exists():
        table.create(models.product_intervals(versions))
        return list(range(table.buckets))
    with stored_once(table.with_bucket(versions), "new-versions", table.spark) as new:
        met = [r[0] for r in new.select(BUCKET_COLUMN).distinct().collect()]  # at most one row per bucket
        held = table.bucket_rows(met)
        changed = held.join(new.select(key).distinct(), key, "left_semi")
        every = changed.select(*new.columns).unionByName(new).drop(BUCKET_COLUMN)
        with stored_once(table.with_bucket(models.product_intervals(every)).select(*held.columns), "cut-intervals", table.spark) as cut:
            differs = cut.exceptAll(held).select(BUCKET_COLUMN)  # intervals that the table does not have as they are
            touched = sorted(r[0] for r in differs.distinct().collect())
            if touched:
                own = table.bucket_rows(touched)
                kept = own.join(cut.select(key).distinct(), key, "left_anti").select(*own.columns)
                table.replace_buckets(kept.unionByName(cut.filter(F.col(BUCKET_COLUMN).isin(touched))), touched)
    return touched
