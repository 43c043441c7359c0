"""Sales measures: signed daily sum (A1) and the four-key sum (A2).

Both are single ``groupBy().agg()`` calls: Spark plans a partial aggregate
before the shuffle, so a hot day or attribute group sends one partial row per
map task, never its raw rows. Money is summed as DECIMAL and returned as
DECIMAL(38,2) so the total does not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def signed_amount(price: str = "sale_price", returned_at: str = "returned_at") -> Column:
    """``IF(returned_at IS NULL, price, price * -1)``."""
    p = F.col(price)
    return F.when(F.col(returned_at).isNull(), p).otherwise(p * -1)


def signed_daily_sum(facts: DataFrame, time_col: str = "created_at", price: str = "sale_price",
                     returned_at: str = "returned_at", day_name: str = "transaction_date",
                     total_name: str = "total_sale") -> DataFrame:
    """A1: per UTC day, sales minus returns."""
    return (facts.groupBy(F.to_date(F.col(time_col)).alias(day_name))
            .agg(F.sum(signed_amount(price, returned_at)).cast(MONEY).alias(total_name)))


def grouped_sum(rows: DataFrame, keys: Sequence[str | Column], price: str = "sale_price",
                total_name: str = "total_sales") -> DataFrame:
    """A2: plain sum by keys; NULL keys form their own group; no sign."""
    return rows.groupBy(*keys).agg(F.sum(F.col(price)).cast(MONEY).alias(total_name))


def sales_by_attributes(rows: DataFrame, time_col: str = "created_at", price: str = "sale_price",
                        attributes: Sequence[str] = ("category", "brand", "department"),
                        day_name: str = "transaction_date",
                        total_name: str = "total_sales") -> DataFrame:
    """A2 as used by the report: (day, category, brand, department) totals."""
    keys = [F.to_date(F.col(time_col)).alias(day_name)] + [F.col(a) for a in attributes]
    return grouped_sum(rows, keys, price, total_name)
