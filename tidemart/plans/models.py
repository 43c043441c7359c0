"""The warehouse models as DataFrame builds (no writes here).

Each function is the SELECT of one model: it takes DataFrames, returns a
DataFrame, and never touches storage. ``tidemart.plans.jobs`` runs these with
their materialization (create, merge, partition replacement).

``days`` is one day, a list of days, or ``None`` for every day (a backfill);
the reference runs one day at a time, which is the one-element case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.periods import before_end_of, day_in, in_window, scope_predicate
from ..operators.asof import asof_join, version_intervals
from ..operators.latest import keep_latest_per_day
from ..operators.measures import sales_by_attributes, signed_daily_sum
from ..operators.merge import latest_per_key, merge

DIMENSION_COLUMNS = ["id", "brand", "department", "category", "updated_at"]
FACT_COLUMNS = [
    "id", "order_id", "user_id", "product_id", "inventory_item_id", "status",
    "created_at", "shipped_at", "delivered_at", "returned_at", "sale_price",
]
REPORT_ATTRIBUTES = ["category", "brand", "department"]


def _scoped(df: DataFrame, column: str, days) -> DataFrame:
    return df if days is None else df.filter(day_in(column, days))


# ------------------------------------------------------------------ H5 / N-W2
def sales_transaction_fact(order_items: DataFrame, days=None, with_id: bool = True) -> DataFrame:
    """Newest version of each order item per day of ``created_at``.

    ``with_id=False`` gives the DAG form, which has no ``id`` column.
    """
    latest = keep_latest_per_day(order_items, "id", "created_at", days)
    cols = FACT_COLUMNS if with_id else FACT_COLUMNS[1:]
    return latest.select(*cols)


# ------------------------------------------------------------------ H3 / N-W1
def product_dimension_daily(products_delta: DataFrame, days=None) -> DataFrame:
    """Newest version of each product per day of ``updated_at``."""
    latest = keep_latest_per_day(products_delta, "id", "updated_at", days)
    return latest.select(*DIMENSION_COLUMNS)


# ------------------------------------------------------------------------ H2
def product_history(products_delta: DataFrame, days=None) -> DataFrame:
    """Every version, no dedup (first run: whole delta; later: one day)."""
    return _scoped(products_delta, "updated_at", days).select(*DIMENSION_COLUMNS)


# ----------------------------------------------------------------------- H11
def product_intervals(history: DataFrame) -> DataFrame:
    return version_intervals(history.select(*DIMENSION_COLUMNS), "id", "updated_at")


# ------------------------------------------------------------------------ H6
def sales_periodic_fact(fact: DataFrame, days=None) -> DataFrame:
    return signed_daily_sum(_scoped(fact, "created_at", days))


# ------------------------------------------------------------------------ H7
def sales_report(fact: DataFrame, product_dim: DataFrame, days=None) -> DataFrame:
    """Day x category x brand x department sales (returns not subtracted).

    Each sale takes the attributes of the product version valid at its time;
    sales before a product's first version keep NULL attributes.
    """
    sales = _scoped(fact, "created_at", days).select("id", "product_id", "created_at", "sale_price")
    if days is not None:  # a version after the last day can match no sale of these days
        product_dim = product_dim.filter(before_end_of("updated_at", days))
    enriched = asof_join(sales, product_dim, fact_key="product_id", version_key="id",
                         fact_time="created_at", version_time="updated_at",
                         columns=REPORT_ATTRIBUTES)
    return sales_by_attributes(enriched)


# ------------------------------------------------------------------------ H8
def newest_changes(delta: DataFrame, days=None, window=None, key: str = "id", stamp: str = "updated_at") -> DataFrame:
    """The day's (or window's) newest change per id: the source of the main table's merge."""
    scoped = _scoped(delta, stamp, days)
    if window is not None:
        scoped = scoped.filter(in_window(stamp, *window))
    return latest_per_key(scoped, key, stamp)


def merge_delta_to_main(main: DataFrame, delta: DataFrame, days=None, window=None,
                        key: str = "id", stamp: str = "updated_at") -> DataFrame:
    """``newest_changes`` merged into an image with the guard.

    The SET list is every column of ``main`` except the key.
    """
    return merge(main, newest_changes(delta, days, window, key, stamp).select(*main.columns), key=key, version_col=stamp)


# ------------------------------------------------------------------------ H1
def product_dim_scd1_source(products_main: DataFrame, days) -> DataFrame:
    """Rows of the main table changed on the given day(s)."""
    return products_main.filter(day_in("updated_at", days)).select(*DIMENSION_COLUMNS)


# ------------------------------------------------------------------------ H4
def product_dim_scoped_source(products_main: DataFrame, day=None, incremental: bool = False,
                              as_of=None, first_day="2022-01-01") -> DataFrame:
    return (products_main
            .filter(scope_predicate("updated_at", day=day, incremental=incremental,
                                    as_of=as_of, first_day=first_day))
            .select(*DIMENSION_COLUMNS))
