"""Top-1 per key, top-N, and simple lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT_KEY = ("badge_id", "event_timestamp")


def first_per_key(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark limits each group to one row per map task before the shuffle, so a key with
    any number of copies sends only one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def newest_copy(df: DataFrame) -> list[Column]:
    """Latest ingestion first; then ``seq`` if the feed has one, else the payload."""
    if "seq" in df.columns:
        ties = ["seq"]
    else:
        ties = [c for c in df.columns if c not in (*EVENT_KEY, "ingestion_time")]
    return [F.col(name).desc() for name in ("ingestion_time", *ties)]


def latest_per_key(df: DataFrame, keys: Sequence = EVENT_KEY) -> DataFrame:
    """One row per event key: the copy ingested last."""
    return first_per_key(df, keys, newest_copy(df))


def newest_first(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; remaining ties are broken by every column, ascending."""
    ties = [F.col(f"`{name}`").asc_nulls_last() for name in df.columns]
    return df.orderBy(*order, *ties).limit(n)


def events_for_badge(raw: DataFrame, badge_id: str, n: int = 10) -> DataFrame:
    """Newest events of one badge."""
    columns = (
        "badge_id", "user_id", "zone_id", "event_timestamp", "signal_strength",
        "signal_quality", "ingestion_time",
    )
    matches = raw.filter(F.col("badge_id") == badge_id).select(*columns)
    return top_n(matches, n, newest_first("ingestion_time"))


def duplicate_keys(df: DataFrame, keys: Sequence = EVENT_KEY) -> DataFrame:
    """Keys held by more than one row; no rows when unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
