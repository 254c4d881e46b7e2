"""Time expressions over TIMESTAMP_NTZ columns. The session zone must be UTC."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the Python process's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def lookback(df: DataFrame, column: str, span: timedelta, as_of: datetime) -> DataFrame:
    """Rows at or after ``as_of - span``; there is no upper bound.

    The column stays bare so the scan can skip row groups. A table partitioned by the
    column's date (``x_time`` by ``x_date``) is pruned to the days in question first.
    """
    oldest = as_of - span
    day = column.removesuffix("_time") + "_date"
    if day in df.columns:
        df = df.filter(F.col(day) >= F.lit(oldest.date()))
    return df.filter(F.col(column) >= ntz(oldest))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end: 0.9 s to 1.1 s counts as one."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def truncate(unit: str, column: Column) -> Column:
    return F.date_trunc(unit, column.cast("timestamp")).cast("timestamp_ntz")


def day_of_week(column: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(column) - 1


def is_after_hours(column: Column) -> Column:
    return (F.hour(column) < 6) | (F.hour(column) >= 22)


def is_weekend(column: Column) -> Column:
    return day_of_week(column).isin(0, 6)
