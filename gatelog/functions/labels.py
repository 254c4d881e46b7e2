"""Searched-CASE bands and display helpers. A null always falls to the last branch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display colour per status.
STATUS_COLORS = {
    "HEALTHY": "green",
    "WARNING": "orange",
    "STALE": "red",
    "SUCCESS": "green",
    "FAILED": "red",
    "SKIPPED": "gray",
}


def signal_quality(signal: Column) -> Column:
    """-80 itself is MEDIUM, -60 itself is STRONG, and so is a missing signal."""
    return F.when(signal < -80, "WEAK").when(signal < -60, "MEDIUM").otherwise("STRONG")


def health_band(seconds: Column, null_status: str = "HEALTHY") -> Column:
    return (
        F.when(seconds > 300, "STALE")
        .when(seconds > 120, "WARNING")
        .when(seconds.isNull(), null_status)
        .otherwise("HEALTHY")
    )


def pruning_band(scan_pct: Column) -> Column:
    return (
        F.when(scan_pct < 20, "EXCELLENT")
        .when(scan_pct < 50, "GOOD")
        .when(scan_pct < 80, "FAIR")
        .otherwise("POOR")
    )


def execution_band(state: Column) -> Column:
    return (
        F.when(state == "SUCCEEDED", "SUCCESS")
        .when(state.isin("FAILED", "SKIPPED"), state)
        .otherwise("UNKNOWN")
    )


def health_color(status: Column) -> Column:
    color = F.lit("gray")
    for name, value in STATUS_COLORS.items():
        color = F.when(status == name, value).otherwise(color)
    return color


def humanize_seconds(seconds: Column) -> Column:
    """``42s``, ``5m 3s``, ``2h 14m``; null stays null. Whole seconds in."""
    whole = seconds.cast("bigint")
    hours, minutes = F.floor(whole / 3600), F.floor(whole / 60)
    return (
        F.when(whole < 60, F.concat(whole.cast("string"), F.lit("s")))
        .when(
            whole < 3600,
            F.concat(minutes.cast("string"), F.lit("m "), F.pmod(whole, F.lit(60)), F.lit("s")),
        )
        .otherwise(
            F.concat(
                hours.cast("string"), F.lit("h "), F.pmod(minutes, F.lit(60)), F.lit("m")
            )
        )
    )
