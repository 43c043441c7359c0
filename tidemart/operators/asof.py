"""Left as-of join and version intervals.

Semantics (the report's join): each fact row gets the attributes of the
newest version with the same key and ``version_time <= fact_time``. Facts with
no such version (before the first version, unknown key, NULL key or time) are
kept with NULL attributes. Exactly one output row per fact row.

One plan at any size. Facts and versions are unioned and their rows shuffled
once, on (key, calendar bucket of the time), so a hot key spreads over as many
tasks as it has buckets. A running ``last(..., ignoreNulls)`` inside each bucket carries
the newest version to the facts (versions stand before facts at equal time,
because the condition is ``>=``). A small table, one row per (key, bucket) of either side and
aggregated before it is shuffled, hands each bucket the last version of the buckets before it. No fact
ever meets more than one version, nothing is collected, and AQE alone decides about broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"
#: Rows that can match nothing (NULL key or time) are spread over this many buckets.
UNMATCHED_BUCKETS = 4096


def time_bucket(stamp: str, bucket: str = "month") -> Column:
    """Number of the calendar month or day of a stamp, from its fields (no time zone)."""
    if bucket == "month":
        return F.year(stamp) * 12 + F.month(stamp)
    if bucket == "day":
        return F.unix_date(F.to_date(F.col(stamp)))
    raise ValueError(f"unknown bucket: {bucket}")


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def version_intervals(history: DataFrame, key: str = "id", stamp: str = "updated_at",
                      valid_from: str = VALID_FROM, valid_to: str = VALID_TO,
                      is_current: str = IS_CURRENT, bucket: str = "month") -> DataFrame:
    """Each version's validity ``[valid_from, valid_to)`` and a current flag.

    Versions are ordered by stamp inside (key, bucket), and versions sharing a
    stamp by the keep-latest tie-break reversed, so the keep-latest winner
    comes last among them; ``lead(stamp)`` gives every loser an empty interval
    ``[t, t)``, which is dropped. The last version of a bucket ends where the
    key's next bucket begins. Versions with a NULL key or stamp can never
    match and are dropped.
    """
    clean = history.filter(F.col(key).isNotNull() & F.col(stamp).isNotNull())
    tiebreak = [c for c in clean.columns if c not in (key, stamp)]
    dealt = clean.withColumn("__b", time_bucket(stamp, bucket)).repartition(key, "__b")
    inside = Window.partitionBy(key, "__b").orderBy(F.col(stamp).asc(), *_ascending(tiebreak))
    heads = clean.groupBy(F.col(key).alias("__k"), time_bucket(stamp, bucket).alias("__hb")).agg(F.min(stamp).alias("__head"))
    after = heads.withColumn("__next", F.lead("__head").over(Window.partitionBy("__k").orderBy("__hb"))).drop("__head")
    joined = (dealt.withColumn("__lead", F.lead(F.col(stamp)).over(inside))
              .join(after, (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__hb"))))
    end = F.coalesce("__lead", "__next")
    return (joined.select(*clean.columns, F.col(stamp).alias(valid_from), end.alias(valid_to))
            .filter(F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
            .withColumn(is_current, F.col(valid_to).isNull()))


def asof_join(facts: DataFrame, versions: DataFrame, *, fact_key: str, version_key: str,
              fact_time: str, version_time: str, columns: Sequence[str],
              version_time_as: str | None = None, bucket: str = "month") -> DataFrame:
    """Left as-of join of ``facts`` to ``versions``.

    ``columns`` are the version attributes to attach (output names as given);
    ``version_time_as`` optionally also returns the matched version's stamp.
    ``bucket`` (month or day) is the stretch of time that one task orders for
    one key: it changes the cost, never the result. Of versions that share key
    and stamp, the one that sorts last by ``columns`` counts.
    """
    attributes = list(dict.fromkeys([*columns, *([version_time] if version_time_as else [])]))
    tiebreak = [F.col("__version").getField(c) for c in dict.fromkeys(columns) if c not in (version_key, version_time)]
    # the versions stand in the facts' own key and time columns, unless the types differ: the shuffle carries nothing twice
    alike = lambda f, v: facts.schema[f].dataType == versions.schema[v].dataType
    key, t = fact_key if alike(fact_key, version_key) else "__key", fact_time if alike(fact_time, version_time) else "__t"
    clean = versions.filter(F.col(version_key).isNotNull() & F.col(version_time).isNotNull())
    version_rows = clean.select(
        F.col(version_key).alias(key), F.col(version_time).alias(t),
        time_bucket(version_time, bucket).alias("__b"), F.struct(*attributes).alias("__version"))
    spread = -1 - F.monotonically_increasing_id() % UNMATCHED_BUCKETS
    unmatched = F.col(fact_key).isNull() | F.col(fact_time).isNull()
    fact_rows = facts.select(
        "*", *[F.col(f).alias(c) for f, c in ((fact_key, key), (fact_time, t)) if f != c],
        F.when(unmatched, spread).otherwise(time_bucket(fact_time, bucket)).cast("int").alias("__b"))
    dealt = fact_rows.unionByName(version_rows, allowMissingColumns=True).repartition(key, "__b")
    is_fact = F.col("__version").isNull()
    running = (Window.partitionBy(key, "__b").orderBy(*[c.asc_nulls_first() for c in (F.col(t), is_fact, *tiebreak)])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = dealt.withColumn("__match", F.last("__version", ignorenulls=True).over(running)).filter(is_fact)

    # the last version of each bucket, and the buckets of the facts: one row each, before anything is shuffled
    place = F.struct(F.col(t).alias("t"), *[c.alias(f"tb{i}") for i, c in enumerate(tiebreak)])
    tails = (version_rows.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__hb"))
             .agg(F.max_by("__version", place).alias("__tail")).withColumn("__asked", F.lit(False)))
    asked = fact_rows.filter(~unmatched).select(F.col(key).alias("__k"), F.col("__b").alias("__hb")).distinct().withColumn("__asked", F.lit(True))
    earlier = (Window.partitionBy("__k").orderBy("__hb", F.col("__asked").desc())  # a bucket asks before its own version
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    handed = (asked.unionByName(tails, allowMissingColumns=True).withColumn("__before", F.last("__tail", ignorenulls=True).over(earlier))
              .filter(F.col("__asked") & F.col("__before").isNotNull()).drop("__tail", "__asked"))
    joined = carried.join(handed, (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__hb")), "left")
    match = F.when(F.col(t).isNotNull(), F.coalesce("__match", "__before"))
    out = [F.col(c) for c in facts.columns] + [match.getField(c).alias(c) for c in columns]
    if version_time_as:
        out.append(match.getField(version_time).alias(version_time_as))
    return joined.select(*out)
