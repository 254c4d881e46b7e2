"""Dimension maintenance: surrogate keys, unknown users, history rows, lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatelog import schemas
from gatelog.functions.times import ntz

# Attributes of a user first seen in an event.
UNKNOWN_USER = {
    "user_name": "UNKNOWN",
    "user_type": "UNKNOWN",
    "department": "UNKNOWN",
    "clearance_level": "PUBLIC",
}


def assign_keys(
    df: DataFrame, key: str, start: int, by: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Number rows from ``start`` without a global sort; unique, not dense.

    ``by`` identifies a row. Rows are placed by its hash into a fixed number of tasks (by
    default the session's shuffle partitions) and sorted there, so the numbering is the
    same when a lost task or the whole plan is run again. Placing by a hash value, not by
    the columns, keeps Spark from reusing an earlier exchange that it may resize.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(n, F.xxhash64(*by)).sortWithinPartitions(*by)
    return placed.withColumn(key, F.lit(start) + F.monotonically_increasing_id())


def dense_keys(
    df: DataFrame, key: str, start: int, by: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Number rows start, start + 1, … without gaps, placed as ``assign_keys`` places them.

    Rows are counted per task first, so ``df`` is evaluated twice; only these counts reach
    the driver, and each task begins where the one before it ends.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(n, F.xxhash64(*by)).sortWithinPartitions(*by)
    row = F.monotonically_increasing_id()
    return placed.withColumn(key, F.lit(start) + within_task(task_counts(placed, row), row))


def task_counts(placed: DataFrame, row: Column) -> dict[int, int]:
    """Rows per task; ``row`` is a row's monotonic id."""
    tasks = placed.select(F.shiftright(row, 33).alias("task")).groupBy("task")
    return {r["task"]: r["n"] for r in tasks.agg(F.count("*").alias("n")).collect()}


def within_task(counts: dict[int, int], row: Column) -> Column:
    """A row's place among all rows, task after task, by the rows per task."""
    before, total = [], 0
    for task in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(task, 0)
    shift = F.get(F.lit(before or [0]).cast("array<bigint>"), F.shiftright(row, 33).cast("int"))
    return shift + row.bitwiseAND(F.lit((1 << 33) - 1))


def next_key(df: DataFrame, key: str) -> int:
    """One past the largest key."""
    return (df.agg(F.max(key)).first()[0] or 0) + 1


def current(users: DataFrame) -> DataFrame:
    return users.filter("is_current")


def valid_at(events: DataFrame, users: DataFrame, moment: str, how: str = "inner") -> DataFrame:
    """Events with the key of the user's version that was valid at ``moment``.

    A version is valid from its start up to its end; a user's first version also stands for the time
    before it. The join is on the user, so a hot user is split as any other join's key is.
    """
    alone = Window.partitionBy("user_id")
    first = F.col("effective_start_date") == F.min("effective_start_date").over(alone)
    versions = users.select(
        F.col("user_id").alias("_user"),
        "user_key",
        F.when(~first, F.col("effective_start_date")).alias("_from"),
        F.col("effective_end_date").alias("_to"),
    )
    at = F.col(moment)
    valid = (F.col("_from").isNull() | (at >= F.col("_from"))) & (
        F.col("_to").isNull() | (at < F.col("_to"))
    )
    return events.join(versions, (F.col("user_id") == F.col("_user")) & valid, how).drop(
        "_user", "_from", "_to")


def unknown_user_ids(events: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct ids in the events that no current user row has."""
    known = current(users).select("user_id")
    return events.select("user_id").distinct().join(known, "user_id", "left_anti")


def new_user_rows(
    events: DataFrame, users: DataFrame, load_ts: datetime, start: int,
    partitions: int | None = None,
) -> DataFrame:
    """The rows an insert-only merge adds to the user dimension."""
    ids = unknown_user_ids(events, users)
    return user_rows(assign_keys(ids, "user_key", start, ["user_id"], partitions), load_ts)


def user_rows(keyed: DataFrame, load_ts: datetime) -> DataFrame:
    """Dimension rows for keyed user ids that no attribute is known of."""
    now = ntz(load_ts)
    values = {
        **{name: F.lit(value) for name, value in UNKNOWN_USER.items()},
        "is_active": F.lit(True),
        "is_current": F.lit(True),
        "effective_start_date": now,
        "created_timestamp": now,
        "updated_timestamp": now,
        "user_id": F.col("user_id"),
        "user_key": F.col("user_key"),
    }
    return keyed.select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schemas.USERS
        ]
    )


def upsert_unknown_users(
    events: DataFrame, users: DataFrame, load_ts: datetime, start: int,
    partitions: int | None = None,
) -> DataFrame:
    """The user dimension after the merge."""
    return users.unionByName(new_user_rows(events, users, load_ts, start, partitions))


def scd2_apply(
    users: DataFrame,
    updates: DataFrame,
    ts: datetime,
    start: int,
    tracked: Sequence[str] = ("user_name", "user_type", "department", "clearance_level"),
    partitions: int | None = None,
) -> DataFrame:
    """Close current rows whose tracked attributes changed and insert their successors.

    ``updates`` holds one row per user_id with every tracked column. Unseen ids are
    inserted; unchanged ids are left alone. Write the result to a new path, never over
    the files it was read from.
    """
    now = ntz(ts)
    incoming = updates.select("user_id", F.struct(*tracked).alias("_new"))
    matched = users.join(incoming, "user_id", "left")
    differs = ~F.struct(*tracked).eqNullSafe(F.col("_new"))
    closing = F.col("is_current") & F.col("_new").isNotNull() & differs
    kept = matched.select(
        *[
            {
                "is_current": F.col("is_current") & ~closing,
                "effective_end_date": F.when(closing, now).otherwise(
                    F.col("effective_end_date")
                ),
                "updated_timestamp": F.when(closing, now).otherwise(
                    F.col("updated_timestamp")
                ),
            }
            .get(name, F.col(name))
            .alias(name)
            for name in users.columns
        ]
    )
    unchanged = current(users).select("user_id", F.struct(*tracked).alias("_old"))
    changed = (
        incoming.join(unchanged, "user_id", "left")
        .filter(~F.col("_new").eqNullSafe(F.col("_old")))
        .select("user_id", "_new.*")
        .distinct()
    )
    keyed = assign_keys(changed, "user_key", start, ["user_id"], partitions)
    inserted = keyed.withColumns(
        {
            "is_active": F.lit(True),
            "is_current": F.lit(True),
            "effective_start_date": now,
            "created_timestamp": now,
            "updated_timestamp": now,
        }
    )
    return kept.unionByName(inserted, allowMissingColumns=True)


def with_reader(events: DataFrame, readers: DataFrame) -> DataFrame:
    """Reader attributes where the reader is known."""
    attributes = readers.select("reader_id", "reader_name", "firmware_version", "is_online")
    return events.join(attributes, "reader_id", "left")


def _has_null(known: DataFrame, key: str) -> Column:
    """A null in the list makes NOT IN unknown for every value."""
    return known.filter(F.col(key).isNull()).exists()


def orphan_ids(events: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``SELECT DISTINCT key … WHERE key NOT IN (known)`` with SQL null semantics.

    A plain anti join on distinct ids plus two null checks. Spark's own NOT IN would
    broadcast the whole dimension, which grows with the data.
    """
    ids = events.select(key).filter(F.col(key).isNotNull()).distinct()
    return ids.filter(~_has_null(known, key)).join(known.select(key), key, "left_anti")


def orphan_events(events: DataFrame, users: DataFrame, zones: DataFrame) -> DataFrame:
    """Events whose user or zone is missing from the dimensions.

    ``a NOT IN (…) OR b NOT IN (…)`` as two joins to distinct keys.
    """
    users = current(users)
    known_users = users.select("user_id").distinct().withColumn("_user", F.lit(True))
    known_zones = zones.select("zone_id").distinct().withColumn("_zone", F.lit(True))
    flagged = events.join(known_zones, "zone_id", "left").join(known_users, "user_id", "left")
    no_user = F.col("user_id").isNotNull() & F.col("_user").isNull()
    no_zone = F.col("zone_id").isNotNull() & F.col("_zone").isNull()
    missing = (no_user & ~_has_null(users, "user_id")) | (
        no_zone & ~_has_null(zones, "zone_id")
    )
    return flagged.filter(missing).select("badge_id", "user_id", "zone_id")
