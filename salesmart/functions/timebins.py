"""Relative time filters and fixed-width time bins.

``now`` is always an argument: a query never reads the clock, so reruns give
the same rows.  Bins follow the convention of counting fixed-width bins from
0001-01-01 (a Monday), so 7-day bins start on Mondays.  Both work on
TIMESTAMP_NTZ columns (the landed data carries no zone) and on TIMESTAMP.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: days from 0001-01-01 to 1970-01-01 (the bin origin).
DAYS_0001_TO_1970 = 719162


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A zone-free timestamp literal."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def newer_than(ts, now, days: int) -> Column:
    """``ts > ago(days)`` with an explicit ``now`` (strict, as the source)."""
    return _c(ts) > ts_literal(now) - F.make_dt_interval(F.lit(days))


def bin_offset_days(days: int) -> int:
    """Start offset of ``days``-wide bins so that they align with 0001-01-01."""
    return (-DAYS_0001_TO_1970) % days


def time_bin(ts, days: int) -> Column:
    """Start of the ``days``-wide bin holding ``ts``.

    A tumbling window is a plain projection (no row expansion), so it stays in
    whole-stage codegen and can feed a partial aggregate.
    """
    if days == 1:
        # date -> timestamp_ntz keeps the bin free of any zone (date_trunc would
        # pass through the session zone and return a zoned timestamp).
        return F.to_date(_c(ts)).cast("timestamp_ntz")
    offset = bin_offset_days(days)
    return F.window(_c(ts), f"{days} days", f"{days} days", f"{offset} days").start
