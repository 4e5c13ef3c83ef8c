"""Calendar predicates and time arithmetic as plain Column expressions.

The reports compare a function of a column with a constant (``YEAR(x) = y``,
``YEARWEEK(x, 1) = YEARWEEK(d, 1)``).  Catalyst does not turn those into
ranges, so the predicate would reach the Parquet scan only as ``IsNotNull``.
The helpers here state the same predicate as a half-open range on the raw
column, which the scan can use for row-group skipping and partition pruning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_date(d: _dt.date | str) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d)[:10])


def ntz_literal(ts: _dt.datetime | _dt.date) -> Column:
    """A zone-free TIMESTAMP_NTZ literal (``F.lit(datetime)`` would be a zoned TIMESTAMP)."""
    if not isinstance(ts, _dt.datetime):
        ts = _dt.datetime(ts.year, ts.month, ts.day)
    return F.expr(f"TIMESTAMP_NTZ '{ts.isoformat(sep=' ')}'")


def _bound(col: ColumnOrName, d: _dt.date, as_timestamp: bool) -> Column:
    # Compare a timestamp column with a zone-free midnight and a date column
    # with a date, so no cast lands on the column side of the predicate.
    if as_timestamp:
        return ntz_literal(d)
    return F.lit(d)


def in_range(col: ColumnOrName, lo: _dt.date, hi: _dt.date, *, timestamp: bool = True) -> Column:
    """``lo <= col < hi`` with ``lo``/``hi`` as dates (midnight for timestamp columns)."""
    c = _col(col)
    return (c >= _bound(col, lo, timestamp)) & (c < _bound(col, hi, timestamp))


def in_year(col: ColumnOrName, year: int, *, timestamp: bool = True) -> Column:
    """``YEAR(col) = year`` as a pushable range."""
    return in_range(col, _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1), timestamp=timestamp)


def week_start(d: _dt.date | str) -> _dt.date:
    """Monday of the ISO week holding ``d`` (``YEARWEEK(d, 1)`` weeks start on Monday)."""
    day = _as_date(d)
    return day - _dt.timedelta(days=day.weekday())


def in_week(col: ColumnOrName, d: _dt.date | str, *, timestamp: bool = True) -> Column:
    """``YEARWEEK(col, 1) = YEARWEEK(d, 1)``: the Monday-to-Sunday week of ``d``.

    Mode 1 weeks start on Monday and the week number follows ISO-8601, so two
    dates share a YEARWEEK exactly when they share a Monday; a range of seven
    days from that Monday is the same set of dates.
    """
    lo = week_start(d)
    return in_range(col, lo, lo + _dt.timedelta(days=7), timestamp=timestamp)


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes elapsed from ``start`` to ``end`` (``TIMESTAMPDIFF(MINUTE, start, end)``).

    Truncates toward zero: 119 s is 1, -119 s is -1.  NULL if either side is NULL.
    Counted on the wall clock of zone-free values, so a DST change in the
    session time zone does not move the result.
    """
    d = epoch_micros(end) - epoch_micros(start)
    whole = F.floor(F.abs(d).cast("decimal(20,0)") / F.lit(60_000_000)).cast("long")
    return F.signum(d).cast("long") * whole


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Calendar days from ``start`` to ``end`` ignoring the time of day (``DATEDIFF(end, start)``)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def plus_hours(ts: ColumnOrName, hours: int) -> Column:
    """``ts + INTERVAL hours HOUR``."""
    return _col(ts) + F.make_dt_interval(hours=F.lit(hours))


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of the wall-clock value, independent of the session time zone.

    Used only to cut time into buckets; any monotone mapping works, and a
    zone-free one keeps DST jumps out of the bucket arithmetic.
    """
    c = _col(ts)
    days = F.datediff(F.to_date(c), F.lit(_dt.date(1970, 1, 1))).cast("long")
    clock = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
    micros = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")  # seconds with fraction
    return days * 86_400_000_000 + clock + micros


def bucket_of(ts: ColumnOrName, bucket_micros: int) -> Column:
    """Index of the fixed-width time bucket holding ``ts``."""
    return F.floor(epoch_micros(ts) / F.lit(bucket_micros)).cast("long")
