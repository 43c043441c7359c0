"""MERGE on a key, as a DataFrame function (J2 guarded, J3 unguarded).

Semantics:

* a source row whose key matches no target row is inserted (target's columns;
  columns the source lacks are NULL);
* a matched target row is updated -- every update column taken from the
  source, the key kept -- always (unguarded) or only when
  ``target.version < source.version`` (guarded; a NULL on either side means
  no update);
* unmatched target rows are kept unchanged; a NULL key never matches, so a
  NULL-key source row is always inserted;
* two source rows with one (non-NULL) key fail the query, as in a warehouse
  MERGE, unless ``dedup=True`` keeps the newest of them by ``version_col``.

One plan at any size: a full outer join on the key that reads each side once.
The check for repeated source keys is a count in that same plan. NULL keys,
which match nothing, carry a row number as a second join key, so they spread
over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import latest_order

ACTION_UPDATE = "update"
ACTION_INSERT = "insert"
ACTION_KEEP = "keep"  # matched, guard refused the update
ACTION_UNTOUCHED = "untouched"


def _side(df: DataFrame, prefix: str, key: str) -> DataFrame:
    """Prefixed columns, a hit flag and the spread of NULL keys."""
    return (df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns], F.lit(True).alias(f"{prefix}hit__"))
            .withColumn(f"{prefix}spread__", F.when(F.col(prefix + key).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))))


def latest_per_key(df: DataFrame, key: str, version_col: str) -> DataFrame:
    """Newest row of each non-NULL key; all rows with a NULL key stay."""
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    window = Window.partitionBy(key, "__spread").orderBy(*latest_order(df, [key], version_col))
    return (df.withColumn("__spread", spread).withColumn("__rank", F.row_number().over(window))
            .filter("__rank = 1").select(*df.columns))


def merge(target: DataFrame, source: DataFrame, key: str = "id", version_col: str | None = None,
          update_columns: Sequence[str] | None = None, dedup: bool = False,
          check_unique: bool = True, action_col: str | None = None) -> DataFrame:
    """Merged image of ``target`` (same columns, same order).

    ``update_columns`` defaults to the columns both sides have, except the
    key; a named column that the source lacks is an error. ``dedup`` needs
    ``version_col``. ``action_col`` adds a column naming what happened to each
    output row.
    """
    target_cols, source_cols = list(target.columns), list(source.columns)
    if key not in target_cols or key not in source_cols:
        raise ValueError(f"merge key {key!r} missing")
    if version_col is not None and (version_col not in target_cols or version_col not in source_cols):
        raise ValueError(f"version column {version_col!r} missing")
    if dedup and version_col is None:
        raise ValueError("dedup needs version_col: nothing else says which row is newest")
    if update_columns is None:
        update_columns = [c for c in target_cols if c != key and c in source_cols]
    lacking = [c for c in update_columns if c not in source_cols]
    if lacking:
        raise ValueError(f"update columns {lacking} missing in the source")

    if dedup:
        source = latest_per_key(source, key, version_col)
    s, t = _side(source, "__s_", key), _side(target, "__t_", key)
    if check_unique and not dedup:
        copies = F.count(F.lit(1)).over(Window.partitionBy(f"__s_{key}", "__s_spread__"))
        message = f"source has more than one row for some {key}; pass dedup=True"
        s = s.withColumn("__s_copies", copies).filter(F.assert_true(F.col("__s_copies") == 1, message).isNull())
    on = (F.col(f"__t_{key}") == F.col(f"__s_{key}")) & (F.col("__t_spread__") == F.col("__s_spread__"))
    return _resolve(t.join(s, on, "full_outer"), target_cols, source_cols, key, version_col, update_columns, action_col)


def _resolve(joined: DataFrame, target_cols: Sequence[str], source_cols: Sequence[str], key: str,
             version_col: str | None, update_columns: Sequence[str],
             action_col: str | None) -> DataFrame:
    t_hit, s_hit = F.col("__t_hit__").isNotNull(), F.col("__s_hit__").isNotNull()
    allow: Column = F.lit(True)
    if version_col is not None:
        allow = F.coalesce(F.col(f"__t_{version_col}") < F.col(f"__s_{version_col}"), F.lit(False))
    is_insert, is_update = ~t_hit & s_hit, t_hit & s_hit & allow
    out = []
    for c in target_cols:
        from_source = F.col(f"__s_{c}") if c in source_cols else F.lit(None)
        take = (is_insert | is_update) if c in update_columns else is_insert
        out.append(F.when(take, from_source).otherwise(F.col(f"__t_{c}")).alias(c))
    if action_col:
        out.append(F.when(is_insert, ACTION_INSERT).when(is_update, ACTION_UPDATE)
                   .when(s_hit, ACTION_KEEP).otherwise(ACTION_UNTOUCHED).alias(action_col))
    return joined.select(*out)
