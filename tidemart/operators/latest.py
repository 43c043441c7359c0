"""Keep-latest: one row per key, the newest by a version column.

Plan shape: ``row_number() over (partition by key order by stamp desc, ...)
= 1``. Spark plans this as a ``WindowGroupLimit`` that keeps the top row per
key inside each map task *before* the shuffle, and again after it, so a hot
key costs one row per map task on the wire, not all of its rows.

Ties on the stamp are broken by every other column (descending, NULLs last),
so the result is repeatable; the oracle SQL uses the same order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_NUMBER_COLUMN = "row_num"


def latest_order(df: DataFrame, keys: Sequence[str], stamp: str,
                 tiebreak: Sequence[str] | None = None) -> list[Column]:
    """Sort order that picks the newest row first: stamp, then tie-breaks."""
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in set(keys) and c != stamp]
    return [F.col(stamp).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]


def rank_latest(df: DataFrame, keys: Sequence[str | Column], stamp: str,
                tiebreak: Sequence[str] | None = None,
                rank_col: str = ROW_NUMBER_COLUMN) -> DataFrame:
    """Add ``row_num`` (1 = newest) per key, as the reference's window does."""
    key_names = [k for k in keys if isinstance(k, str)]
    window = Window.partitionBy(*keys).orderBy(*latest_order(df, key_names, stamp, tiebreak))
    return df.withColumn(rank_col, F.row_number().over(window))


def keep_latest(df: DataFrame, keys: Sequence[str | Column], stamp: str,
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key; the helper column is dropped again."""
    ranked = rank_latest(df, keys, stamp, tiebreak)
    return ranked.filter(F.col(ROW_NUMBER_COLUMN) == 1).drop(ROW_NUMBER_COLUMN)


def keep_latest_per_day(df: DataFrame, key: str, stamp: str,
                        days: Sequence[str] | None = None,
                        tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Newest row per (key, UTC day of the stamp), optionally for listed days.

    The day filter goes *under* the window (moving it above would change the
    answer) and is written on the raw stamp column, so it reaches the scan as
    a range predicate when the stamp is a stored column.
    """
    from ..functions.periods import day_in

    if days is not None:
        df = df.filter(day_in(stamp, days))
    return keep_latest(df, [key, F.to_date(F.col(stamp))], stamp, tiebreak)
