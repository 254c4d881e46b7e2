"""Staging rows to enriched facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog import schemas
from gatelog.functions.times import day_of_week, is_after_hours, is_weekend, ntz
from gatelog.operators.dims import current, valid_at
from gatelog.operators.selection import EVENT_KEY, latest_per_key
from gatelog.sources.events import MISSING_SIGNAL


def stage_batch(changes: DataFrame) -> DataFrame:
    """One row per event key within this batch, the copy ingested last."""
    kept = [c for c in (*schemas.STAGED_COLUMNS, "seq") if c in changes.columns]
    return latest_per_key(changes.select(*kept))


def unstaged(staged: DataFrame, staging: DataFrame) -> DataFrame:
    """Insert-only merge: rows whose key no earlier batch staged."""
    return staged.join(staging.select(*EVENT_KEY), list(EVENT_KEY), "left_anti")


def times_present(changes: DataFrame) -> Column:
    """A filter on ``event_timestamp`` spanning the batch, for row-group pruning."""
    low, high = changes.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    if low is None:
        return F.lit(False)
    return F.col("event_timestamp").between(ntz(low), ntz(high))


def drop_faint(events: DataFrame, floor: float = -90, keep_missing: bool = True) -> DataFrame:
    """Drop signals below ``floor``; the missing-signal default is spared unless told not to."""
    signal = F.col("signal_strength")
    keep = signal.isNull() | (signal >= floor)
    return events.filter(keep | (signal == MISSING_SIGNAL) if keep_missing else keep)


def date_parts(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """Calendar columns and time flags of the fact table."""
    ts = F.col(column)
    return df.withColumns(
        {
            "event_date": F.to_date(ts),
            "event_hour": F.hour(ts),
            "event_day_of_week": day_of_week(ts),
            "is_after_hours": is_after_hours(ts),
            "is_weekend": is_weekend(ts),
        }
    )


def enrich(
    staged: DataFrame, users: DataFrame, zones: DataFrame, how: str = "inner",
    version: str = "current",
) -> DataFrame:
    """Attach user and zone keys. Inner drops unknown zones; ``left`` keeps null keys.

    ``version`` takes the user's ``current`` row, or with ``event`` the one valid at the event's time.

    No broadcast is forced: the user dimension grows with the data, so Spark broadcasts
    it only below its size threshold and otherwise splits hot users' partitions
    (adaptive skew join). Several current rows of one user fan out, as in SQL.
    """
    user_keys = current(users).select("user_id", "user_key")
    zone_keys = zones.select(
        "zone_id", "zone_key", F.col("is_restricted").alias("is_restricted_access")
    )
    placed = staged.join(zone_keys, "zone_id", how)
    if version == "event":
        return date_parts(valid_at(placed, users, "event_timestamp", how))
    return date_parts(placed.join(user_keys, "user_id", how))


def event_dates(staged: DataFrame) -> list[date]:
    """The dates of a batch's events.

    They reach the driver; there are no more of them than days in the calendar, and
    usually a few.
    """
    dates = staged.select(F.to_date("event_timestamp").alias("event_date"))
    return [row[0] for row in dates.distinct().collect()]


def dates_present(staged: DataFrame) -> Column:
    """A filter on ``event_date`` that holds for the dates of the batch and for no other."""
    return F.col("event_date").isin(event_dates(staged))


def new_facts(
    enriched: DataFrame, facts: DataFrame, dates: Column | None = None,
    held: Sequence[date] | None = None,
) -> DataFrame:
    """Rows whose event key is not loaded yet.

    ``dates`` narrows the facts to the batch's date partitions before the join. ``held`` names the
    dates that any of the facts have, if they are known: rows of other dates, usually nearly all, are
    new and need no join, so they are not shuffled for it.
    """
    keys = ["event_date", *EVENT_KEY]
    loaded = (facts if dates is None else facts.filter(dates)).select(*keys)
    if held is None:
        return enriched.join(loaded, keys, "left_anti")
    if not held:
        return enriched
    asked = F.coalesce(F.col("event_date").isin(list(held)), F.lit(False))
    unloaded = enriched.filter(asked).join(loaded, keys, "left_anti").select(*enriched.columns)
    return enriched.filter(~asked).unionByName(unloaded)


def fact_columns(df: DataFrame, event_key: Column, load_ts: datetime) -> DataFrame:
    """The fact table's columns in declared order and type."""
    values = {"event_key": event_key, "fact_load_time": ntz(load_ts)}
    return df.select(
        *[
            values.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
            for field in schemas.FACTS
        ]
    )


def load_facts(
    staged: DataFrame,
    users: DataFrame,
    zones: DataFrame,
    facts: DataFrame,
    unique: bool = False,
    how: str = "inner",
    dates: Column | None = None,
    version: str = "current",
    held: Sequence[date] | None = None,
) -> DataFrame:
    """Enriched rows to append; ``held`` as in ``new_facts``.

    Two staged copies of one key in the same call both pass the check against the
    facts; ``unique`` keeps the copy ingested last instead.
    """
    source = latest_per_key(staged) if unique else staged
    return new_facts(enrich(source, users, zones, how, version), facts, dates, held)
