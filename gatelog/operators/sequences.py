"""Order-dependent operators: change against the previous row, runs, gaps, dwell time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatelog.functions.times import ntz, truncate


def with_previous(df: DataFrame, order: str, value: str) -> DataFrame:
    """Add ``previous_<value>``. For aggregated rows only: one per hour or day."""
    calendar = Window.orderBy(order)
    return df.withColumn(f"previous_{value}", F.lag(value).over(calendar))


def change_pct(value: Column, previous: Column) -> Column:
    """Percentage change; null when there is no previous value or it is zero."""
    change = value.cast("double") - previous.cast("double")
    return 100 * change / F.nullif(previous.cast("double"), F.lit(0.0))


def hour_spine(spark, start: datetime, end: datetime) -> DataFrame:
    """Every hour from start's to end's, one row each."""
    step = F.expr("INTERVAL 1 HOUR")
    first, last = truncate("hour", ntz(start)), truncate("hour", ntz(end))
    return spark.range(1).select(F.explode(F.sequence(first, last, step)).alias("hour"))


def runs(df: DataFrame, keys: list[str], order: list[Column], flag: Column) -> DataFrame:
    """Number the maximal runs of consecutive rows where ``flag`` holds.

    Rows outside a run are dropped; ``run`` counts the breaks seen so far.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order)
    breaks = F.sum(F.when(flag, 0).otherwise(1)).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("run", breaks).filter(flag)


def dwell_times(
    events: DataFrame, zone: str = "zone_id", max_stay: timedelta | None = None
) -> DataFrame:
    """Minutes from each ENTRY to the next event of the badge in the zone, if an EXIT.

    The look-ahead runs inside (badge, zone, hour), so a hot badge is spread over its
    hours. Each hour also receives a copy of the first event after it, found on a
    per-hour aggregate, which makes the result equal to one look-ahead per badge.
    """
    place = ["badge_id", zone]
    rows = events.select(*place, "event_timestamp", "direction").withColumn(
        "_hour", truncate("hour", F.col("event_timestamp"))
    )
    heads = rows.groupBy(*place, "_hour").agg(
        F.min(F.struct("event_timestamp", "direction")).alias("_head")
    )
    earlier = F.lag("_hour").over(Window.partitionBy(*place).orderBy("_hour"))
    lookahead = (
        heads.withColumn("_hour", earlier)
        .filter("_hour is not null")
        .select(*place, "_head.*", "_hour")
    )
    both = rows.withColumn("_own", F.lit(True)).unionByName(
        lookahead.withColumn("_own", F.lit(False))
    )
    hourly = Window.partitionBy(*place, "_hour").orderBy("event_timestamp", "direction")
    paired = both.withColumns(
        {
            "exit_timestamp": F.lead("event_timestamp").over(hourly),
            "_next": F.lead("direction").over(hourly),
        }
    ).filter("_own AND direction = 'ENTRY' AND _next = 'EXIT'")
    seconds = F.unix_micros(F.col("exit_timestamp").cast("timestamp")) - F.unix_micros(
        F.col("event_timestamp").cast("timestamp")
    )
    stays = paired.select(
        *place,
        F.col("event_timestamp").alias("entry_timestamp"),
        "exit_timestamp",
        (seconds / F.lit(60_000_000.0)).alias("dwell_time_minutes"),
    )
    if max_stay is None:
        return stays
    return stays.filter(F.col("dwell_time_minutes") <= max_stay.total_seconds() / 60)
