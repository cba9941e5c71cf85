"""Time helpers: local-time shift, Monday week buckets, run stamps.

Inputs are TIMESTAMP_NTZ holding UTC. Every helper stays on NTZ / DATE types so
results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shifted(ts, hours: int = 5, minutes: int = 30) -> Column:
    """Stored UTC time moved to local wall-clock time."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes))


def week_bucket(ts, hours: int = 5, minutes: int = 30) -> Column:
    """Monday of the local-time week, as a DATE."""
    return F.trunc(F.to_date(shifted(ts, hours, minutes)), "week")


def week_label(ts, hours: int = 5, minutes: int = 30) -> Column:
    """Monday of the local-time week as a `yyyy-MM-dd` string."""
    return F.date_format(week_bucket(ts, hours, minutes), "yyyy-MM-dd")


def ntz_literal(value: dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (comparisons against it push down to Parquet)."""
    if isinstance(value, dt.datetime):
        s = value.strftime("%Y-%m-%d %H:%M:%S")
    else:
        s = value.strftime("%Y-%m-%d 00:00:00")
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


def run_stamp(as_of, hours: int = 5, minutes: int = 30, zone_label: str = "IST") -> Column:
    """`dd MMM yyyy, HH:mm <zone>` of a UTC instant shifted to local time."""
    return F.date_format(shifted(as_of, hours, minutes), f"dd MMM yyyy, HH:mm '{zone_label}'")
