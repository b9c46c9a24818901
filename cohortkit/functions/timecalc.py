"""Time arithmetic with the reference's whole-unit semantics.

``TIMESTAMP_DIFF(a, b, HOUR)`` in the reference counts whole hours from b to
a, truncated toward zero. Spark's ``timestampdiff(HOUR, b, a)`` has exactly
that meaning (the argument order is reversed).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def whole_hours(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole hours from ``start`` to ``end`` (negative when end < start)."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def whole_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def hours(n: float) -> Column:
    """An interval of ``n`` hours, usable as ``ts + hours(6)``."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(n) * 3600.0))


def shift(ts: ColumnOrName, n_hours: float) -> Column:
    """``ts`` moved by ``n_hours`` (keeps timestamp_ntz as timestamp_ntz)."""
    if n_hours == 0:
        return _c(ts)
    return _c(ts) + hours(n_hours)


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since the epoch, monotone in ``ts`` in any session zone.

    A ``timestamp`` keeps its instant. A ``timestamp_ntz`` is read as a UTC
    wall clock (rebuilt from its fields with ``make_timestamp(..., 'UTC')``):
    converting it through a DST-observing session zone would reorder times
    inside the spring-forward gap. The branch depends only on the column's
    type (``typeof`` is folded at planning).
    """
    c = _c(ts)
    secs = F.date_part(F.lit("SECOND"), c)            # seconds with microseconds
    as_utc = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                              F.minute(c), secs, F.lit("UTC"))
    return F.when(F.typeof(c) == F.lit("timestamp_ntz"), F.unix_micros(as_utc)) \
            .otherwise(F.unix_micros(c.cast("timestamp")))


def time_bucket(ts: ColumnOrName, width_hours: float) -> Column:
    """Integer bucket of a fixed width in hours, for band joins and slices."""
    width_us = int(round(width_hours * 3600 * 1_000_000))
    return F.floor(epoch_micros(ts) / F.lit(width_us)).cast("long")
