"""Ratios, unit scaling and conditional counts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024.0**3
MIB = 1024.0**2


def ratio(numerator: Column, denominator: Column, digits: int, scale: str = "1") -> Column:
    """``scale * numerator / denominator``, half-up, null for a zero denominator.

    Computed on decimals so that rounding is exact, then returned as a double.
    """
    scaled = F.lit(Decimal(scale)) * numerator.cast("decimal(24,0)")
    safe = F.nullif(denominator, F.lit(0)).cast("decimal(20,0)")
    return F.round(scaled / safe, digits).cast("double")


def pct(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 2, "100.0")


def round_half_up(column: Column, digits: int) -> Column:
    return F.round(column, digits).cast("double")


def gib(total_bytes: Column) -> Column:
    return total_bytes / F.lit(GIB)


def mib(total_bytes: Column) -> Column:
    return total_bytes / F.lit(MIB)


def sum_if(condition: Column) -> Column:
    """SUM(CASE WHEN … THEN 1 ELSE 0 END): null over no rows, unlike count_if."""
    return F.sum(F.when(condition, 1).otherwise(0))
