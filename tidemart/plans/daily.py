"""One day of the warehouse schedule, in dependency order.

The reference runs these as separate scheduled tasks and model runs; here
they are one function over DataFrame sources and catalog tables:

1. H8  main table <- the day's newest product changes (guarded merge)
2. H1  SCD1 product dimension <- main rows changed that day (guarded)
3. H2  product history <- the day's versions (idempotent by day), and the
   version intervals of the products they belong to (H11)
4. H3  daily product history <- newest version per product of the day
5. H5  sales transaction fact <- newest item version per id of the day
6. H6  sales periodic fact <- the day's signed total (reads the fact table)
7. H7  sales report <- the day's sales with their product version

Every step is rerunnable: re-running a day leaves the same tables.

CLI (fixture sources): python -m tidemart.plans.daily SF_DIR WAREHOUSE DAY [DAY ...]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from ..functions.periods import as_date
from ..sinks.tables import DayTable, KeyTable
from . import jobs


def warehouse_tables(spark: SparkSession, root: str, database: str = "default") -> dict:
    """The warehouse's catalog tables, with their folders below ``root``."""
    root = root.rstrip("/")

    def day(name: str, stamp: str) -> DayTable:
        return DayTable(spark, f"{database}.{name}", f"{root}/{name}", stamp)

    def image(name: str) -> KeyTable:
        return KeyTable(spark, f"{database}.{name}", f"{root}/{name}")

    return {
        "main": image("products_main"), "scd1": image("product_dimension_type_1"), "intervals": image("product_dimension_intervals"),
        "history": day("product_dimension_type_2", "updated_at"), "daily": day("product_dimension", "updated_at"),
        "fact": day("sales_transaction_fact", "created_at"), "periodic": day("sales_periodic_fact", "transaction_date"),
        "report": day("sales_report", "transaction_date"),
    }


def run_day(spark: SparkSession, order_items: DataFrame, products_delta: DataFrame,
            root: str, day, initial_main: DataFrame | None = None, database: str = "default") -> dict:
    """Run every model for ``day``; returns the tables it wrote."""
    day = as_date(day)
    t = warehouse_tables(spark, root, database)
    if not t["main"].exists():
        if initial_main is None:
            raise ValueError("the main table does not exist yet: pass initial_main")
        t["main"].create(initial_main)
    jobs.run_merge_delta_to_main(t["main"], products_delta, days=[day])            # H8
    jobs.run_product_dim_scd1(t["scd1"], t["main"].read(), [day])                  # H1
    jobs.run_product_history(t["history"], products_delta, [day])                  # H2
    jobs.run_product_intervals(t["intervals"], products_delta, [day])              # H2 + H11
    jobs.run_product_dimension_daily(t["daily"], products_delta, [day])            # H3
    jobs.run_sales_transaction_fact(t["fact"], order_items, [day])                 # H5
    jobs.run_sales_periodic_fact(t["periodic"], t["fact"], [day])                  # H6
    jobs.run_sales_report(t["report"], t["fact"], t["daily"].read(), [day])        # H7
    return t


def main(argv: list[str]) -> None:
    from ..session import build_session
    from ..sources import fixtures as fx

    if len(argv) < 4:
        raise SystemExit(__doc__)
    sf_dir, root, days = argv[1], argv[2], argv[3:]
    spark = build_session()
    items, delta = fx.order_items_source(spark, sf_dir), fx.products_delta(spark, sf_dir)
    for day in days:
        run_day(spark, items, delta, root, day, initial_main=fx.products_main(spark, sf_dir))
        print(f"ran {day}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
