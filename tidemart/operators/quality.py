"""Key checks: ``unique`` and ``not_null``. A check returns the offending
rows; zero rows means it passes.

``unique`` is a partial-then-final aggregate (hot values cost one partial row
per map task); ``not_null`` is a pushed filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str, value_name: str = "unique_field",
                 count_name: str = "n_records") -> DataFrame:
    """Values of ``column`` seen more than once (NULLs ignored), with counts."""
    return (df.select(F.col(column).alias(value_name))
            .filter(F.col(value_name).isNotNull())
            .groupBy(value_name)
            .agg(F.count(F.lit(1)).alias(count_name))
            .filter(F.col(count_name) > 1))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def passes(check_result: DataFrame) -> bool:
    """True when a check found nothing (reads at most one row)."""
    return check_result.limit(1).count() == 0
