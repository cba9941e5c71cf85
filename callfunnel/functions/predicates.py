"""Row predicates shared by the scans: soft delete, cushion dates, membership."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.functions.timefns import ntz_literal


def live(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    """Soft-delete filter: keep rows whose delete stamp is NULL."""
    return df.filter(F.col(deleted_at).isNull())


def since(df: DataFrame, start: dt.date | dt.datetime, col: str = "created_at") -> DataFrame:
    """Raw-time lower bound `col >= start` (pushed to the Parquet scan)."""
    return df.filter(F.col(col) >= ntz_literal(start))


def local_since(df: DataFrame, start: dt.date, col: str = "start_time",
                hours: int = 5, minutes: int = 30) -> DataFrame:
    """`col + shift >= start`, written as `col >= start - shift` so it stays sargable."""
    bound = dt.datetime.combine(start, dt.time()) - dt.timedelta(hours=hours, minutes=minutes)
    return df.filter(F.col(col) >= ntz_literal(bound))


def flag(cond: Column) -> Column:
    """0/1 integer flag; a NULL condition gives 0 (CASE WHEN semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
