"""Day and hour arithmetic as Spark column expressions.

All predicates are written on the raw stamp column (never on a derived
``to_date``/``date_trunc`` value) so that Parquet and JDBC scans receive them
as pushed range filters. Days are UTC calendar days; stamps are
``timestamp_ntz`` unless a ``kind`` says otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DayLike = "str | dt.date"

# The reference's first-build lower bound for the unguarded dimension.
DEFAULT_FIRST_DAY = "2022-01-01"
# Staged-file prefix layout: "<day>/<hour:minute:second>" of the window start.


def as_date(day) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(str(day)[:10])


def as_datetime(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def typed_lit(value, kind: str = "timestamp_ntz") -> Column:
    """Literal of the stamp's own type, so no cast wraps the column."""
    if kind == "date":
        return F.lit(as_date(value).isoformat()).cast("date")
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast(kind)


def col_of(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


# ---------------------------------------------------------------- F3, S3, S4
def in_window(column, start, end, kind: str = "timestamp_ntz") -> Column:
    """Half-open ``start <= column < end``: both bounds reach the scan."""
    c = col_of(column)
    return (c >= typed_lit(start, kind)) & (c < typed_lit(end, kind))


# ------------------------------------------------------------------- F1, X8
def day_ranges(days: Iterable) -> list[tuple[dt.date, dt.date]]:
    """Sorted distinct days merged into half-open [first, last + 1) runs."""
    ordered = sorted({as_date(d) for d in days})
    runs: list[tuple[dt.date, dt.date]] = []
    for day in ordered:
        nxt = day + dt.timedelta(days=1)
        if runs and runs[-1][1] == day:
            runs[-1] = (runs[-1][0], nxt)
        else:
            runs.append((day, nxt))
    return runs


def day_in(column, days, kind: str = "timestamp_ntz") -> Column:
    """``DATE(column) IN days`` as an OR of pushed half-open ranges.

    ``days`` is one day or a list of days. Consecutive days collapse into a
    single range, so a month of days is one predicate.
    """
    if isinstance(days, (str, dt.date)):
        days = [days]
    runs = day_ranges(days)
    if not runs:
        return F.lit(False)
    predicate = None
    for start, end in runs:
        term = in_window(column, start, end, kind)
        predicate = term if predicate is None else (predicate | term)
    return predicate


def day_equals(column, day, kind: str = "timestamp_ntz") -> Column:
    """``DATE(column) = day``."""
    return day_in(column, [day], kind)


def day_at_least(column, first_day, kind: str = "timestamp_ntz") -> Column:
    """``DATE(column) >= first_day`` (a pushed lower bound)."""
    return col_of(column) >= typed_lit(as_date(first_day), kind)


def before_end_of(column, days, kind: str = "timestamp_ntz") -> Column:
    """``column`` is before the end of the last listed day (a pushed upper bound)."""
    listed = [days] if isinstance(days, (str, dt.date)) else days
    last = max((as_date(d) for d in listed), default=None)
    if last is None:
        return F.lit(False)
    return col_of(column) < typed_lit(last + dt.timedelta(days=1), kind)


def yesterday(as_of=None) -> dt.date:
    """The day before ``as_of`` (default: today, UTC)."""
    base = as_date(as_of) if as_of is not None else dt.datetime.now(dt.timezone.utc).date()
    return base - dt.timedelta(days=1)


def scope_predicate(column, day=None, incremental: bool = False, as_of=None,
                    first_day=DEFAULT_FIRST_DAY, kind: str = "timestamp_ntz") -> Column:
    """explicit day(s) if given, else yesterday when the target exists,
    else everything since the first day."""
    if day is not None:
        return day_in(column, day, kind)
    if incremental:
        return day_equals(column, yesterday(as_of), kind)
    return day_at_least(column, first_day, kind)


# ------------------------------------------------------------------------ S5
def change_window(run_time, hours: int = 1) -> tuple[dt.datetime, dt.datetime]:
    """Hourly change window of a run: end = run time floored to the hour,
    start = end - ``hours`` (the reference uses one hour)."""
    end = as_datetime(run_time).replace(minute=0, second=0, microsecond=0)
    return end - dt.timedelta(hours=hours), end


#: Layout of a staged window: day folder, then hour folder, named by the window's start.
PREFIX_DAY, PREFIX_TIME = "%Y-%m-%d", "%H:%M:%S"


def window_prefix(start) -> str:
    """Staging prefix of a window start, in the layout that ``prefix_col`` gives rows."""
    return "/".join(as_datetime(start).strftime(part) for part in (PREFIX_DAY, PREFIX_TIME))


def window_end_col(run_time) -> Column:
    """Column form of S5: the run time floored to its hour."""
    return hour_of(run_time)


def window_start_col(run_time) -> Column:
    return F.timestamp_add("HOUR", F.lit(-1), window_end_col(run_time))


def format_day(column) -> Column:
    """``YYYY-MM-DD`` of a stamp, from its own fields.

    ``date_format`` would pass a ``timestamp_ntz`` through the session time
    zone (a wall-clock time in a DST gap would print an hour later).
    """
    c = col_of(column)
    return F.format_string("%04d-%02d-%02d", F.year(c), F.month(c), F.dayofmonth(c))


def format_time(column) -> Column:
    """``HH:MM:SS`` of a stamp, from its own fields (no time zone)."""
    c = col_of(column)
    return F.format_string("%02d:%02d:%02d", F.hour(c), F.minute(c), F.second(c))


def prefix_col(start) -> Column:
    """The staged prefix ``YYYY-MM-DD/HH:MM:SS`` of a window start."""
    return F.concat(format_day(start), F.lit("/"), format_time(start))


def hour_of(column) -> Column:
    """Hour bucket of a stamp (``TIMESTAMP_TRUNC(ts, HOUR)``), kept as ntz.

    Built from the stamp's own fields, so no session time zone is involved
    (``date_trunc`` would go through a zoned timestamp).
    """
    c = col_of(column)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


# --------------------------------------------------------------------- X1-X7
def day_of(column) -> Column:
    """``DATE(ts)``."""
    return F.to_date(col_of(column))


def day_start(column) -> Column:
    """``TIMESTAMP(DATE(ts))``."""
    return F.to_date(col_of(column)).cast("timestamp_ntz")


def trunc_to(unit: str, column) -> Column:
    """``TIMESTAMP_TRUNC(ts, unit)`` for year, month, day, hour, minute or second.

    Built from the stamp's own fields: no session time zone is involved.
    """
    c = col_of(column)
    fields = {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c),
              "minute": F.minute(c), "second": F.floor(F.second(c))}
    unit = unit.lower()
    if unit not in fields:
        raise ValueError(f"unknown unit: {unit}")
    kept = list(fields)[:list(fields).index(unit) + 1]
    first = {"month": 1, "day": 1}
    return F.make_timestamp_ntz(*(fields[f].cast("int") if f in kept else F.lit(first.get(f, 0)) for f in fields))


def current_day(as_of: Column | None = None) -> Column:
    """``CURRENT_DATE()`` in UTC as a column: one value for the whole query, whatever the session zone."""
    now = F.current_timestamp() if as_of is None else as_of
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), now.cast("timestamp_ntz")))


def minus_days(column, n: int = 1) -> Column:
    """``TIMESTAMP_SUB(ts, INTERVAL n DAY)``."""
    return F.timestamp_add("DAY", F.lit(-n), col_of(column))
