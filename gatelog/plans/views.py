"""The ten monitoring views. Each takes tables and an ``as_of`` time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.functions.labels import execution_band, health_band, pruning_band
from gatelog.functions.numbers import gib, mib, pct, ratio, round_half_up, sum_if
from gatelog.functions.times import lookback, ntz, seconds_between, truncate
from gatelog.operators.dims import current
from gatelog.operators.selection import EVENT_KEY, newest_first, top_n

MINUTE, HOUR, DAY = timedelta(minutes=1), timedelta(hours=1), timedelta(days=1)
RAW_TABLE, FACT_TABLE = "RAW_BADGE_EVENTS", "FCT_ACCESS_EVENTS"


def one_row(*parts: DataFrame) -> DataFrame:
    """Put single-row aggregates with different columns side by side, without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def age(column: Column, as_of: datetime) -> Column:
    return seconds_between(column, ntz(as_of))


def channel_status(tables, as_of: datetime) -> DataFrame:
    """Ingestion per target over the last hour; no row when idle."""
    recent = lookback(tables.migration, "end_time", HOUR, as_of)
    return (
        recent.filter(F.col("table_name") == RAW_TABLE)
        .groupBy(F.col("table_name").alias("pipe_name"))
        .agg(
            F.max("end_time").alias("last_ingestion_time"),
            age(F.max("end_time"), as_of).alias("seconds_since_last_ingestion"),
            F.sum("num_rows_migrated").alias("total_rows_inserted"),
            gib(F.sum("num_bytes_migrated")).alias("total_gb_inserted"),
            F.countDistinct(truncate("minute", F.col("end_time"))).alias(
                "active_minutes_last_hour"
            ),
            F.avg("num_rows_migrated").alias("avg_rows_per_insert"),
            F.max("num_rows_migrated").alias("max_rows_per_insert"),
            F.sum("credits_used").alias("total_credits_used"),
        )
    )


def ingestion_metrics(tables, as_of: datetime, extended: bool = False) -> DataFrame:
    """Hourly volume, signal and occupancy over the last day; empty hours are absent.

    The average includes the missing-signal default. ``extended`` adds unique_users and
    avg_events_per_minute.
    """
    hour = truncate("hour", F.col("ingestion_time")).alias("ingestion_hour")
    extra = [F.countDistinct("user_id").alias("unique_users")] if extended else []
    hourly = (
        lookback(tables.raw, "ingestion_time", DAY, as_of)
        .groupBy(hour)
        .agg(
            F.count("*").alias("event_count"),
            F.countDistinct("badge_id").alias("unique_badges"),
            F.countDistinct("zone_id").alias("unique_zones"),
            F.avg("signal_strength").alias("avg_signal_strength"),
            sum_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
            sum_if(F.col("direction") == "ENTRY").alias("entry_count"),
            sum_if(F.col("direction") == "EXIT").alias("exit_count"),
            *extra,
        )
    )
    events = F.col("event_count")
    columns = [
        F.col("ingestion_hour"),
        events,
        ratio(events, F.lit(3600), 6).alias("events_per_second"),
        F.col("unique_badges"),
        F.col("unique_zones"),
        round_half_up(F.col("avg_signal_strength"), 2).alias("avg_signal_strength"),
        F.col("weak_signal_count"),
        pct(F.col("weak_signal_count"), events).alias("weak_signal_pct"),
        F.col("entry_count"),
        F.col("exit_count"),
        (F.col("entry_count") - F.col("exit_count")).alias("net_occupancy_change"),
    ]
    if extended:
        columns += [
            F.col("unique_users"),
            ratio(events, F.lit(60), 6).alias("avg_events_per_minute"),
        ]
    return hourly.select(*columns).orderBy(newest_first("ingestion_hour"))


def active_badges(tables, as_of: datetime, today_of: datetime | None = None) -> DataFrame:
    """Last known zone and today's events per badge seen in the last day.

    Latest row and count come from one aggregation, so events are shuffled once and
    combined before it. ``today_of`` sets the day counted, by default that of ``as_of``.
    """
    events = lookback(tables.raw, "ingestion_time", DAY, as_of)
    ties = ["seq"] if "seq" in events.columns else ["user_id", "zone_id"]
    order = F.struct("event_timestamp", "ingestion_time", *ties)
    today = F.to_date(ntz(today_of or as_of))
    badges = events.groupBy("badge_id").agg(
        F.max_by(F.struct("user_id", "zone_id", "event_timestamp"), order).alias("last"),
        F.count_if(F.to_date("event_timestamp") == today).alias("event_count_today"),
    )
    latest = badges.select(
        "badge_id",
        "last.user_id",
        F.col("last.zone_id").alias("last_zone"),
        F.col("last.event_timestamp").alias("last_seen"),
        "event_count_today",
    )
    names = current(tables.users).select("user_id", "user_name")
    return latest.join(names, "user_id", "left").select(
        "badge_id", "user_id", "user_name", "last_zone", "last_seen", "event_count_today"
    )


def layer_update(df: DataFrame, layer: str, column: str, as_of: datetime) -> DataFrame:
    """Latest load time and row count of one layer over the last hour; always one row."""
    return lookback(df, column, HOUR, as_of).agg(
        F.lit(layer).alias("layer"),
        F.max(column).alias("last_update"),
        F.count("*").alias("row_count"),
    )


def with_health(layers: DataFrame, as_of: datetime, null_status: str = "HEALTHY") -> DataFrame:
    seconds = age(F.col("last_update"), as_of)
    return layers.select(
        "layer",
        "last_update",
        seconds.alias("seconds_since_update"),
        "row_count",
        health_band(seconds, null_status).alias("health_status"),
    )


def end_to_end_latency(tables, as_of: datetime, null_status: str = "HEALTHY") -> DataFrame:
    """Exactly one row per layer. An idle layer has no last update and ``null_status``."""
    layers = (
        layer_update(tables.raw, "RAW", "ingestion_time", as_of)
        .unionByName(layer_update(tables.stg, "STAGING", "staging_time", as_of))
        .unionByName(layer_update(tables.facts, "ANALYTICS", "fact_load_time", as_of))
    )
    rank = F.when(F.col("layer") == "RAW", 1).when(F.col("layer") == "STAGING", 2).otherwise(3)
    return with_health(layers, as_of, null_status).orderBy(rank)


def freshness(totals: DataFrame, table: str, layer: str, as_of: datetime) -> DataFrame:
    """Newest event and load of one table; rows_last_hour is null for an empty table."""
    newest_event, newest_load = F.max("newest_event"), F.max("load_time")
    recent = F.when(F.col("load_time") >= ntz(as_of - HOUR), F.col("row_count")).otherwise(0)
    return totals.filter(F.col("layer") == layer).agg(
        F.lit(table).alias("table_name"),
        newest_event.alias("last_event_timestamp"),
        newest_load.alias("last_ingestion_timestamp"),
        age(newest_event, as_of).alias("event_age_seconds"),
        age(newest_load, as_of).alias("ingestion_age_seconds"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.sum(recent).alias("rows_last_hour"),
    )


def data_freshness(tables, as_of: datetime) -> DataFrame:
    """From what each load added to the tables, not from their rows."""
    raw = freshness(tables.totals, RAW_TABLE, "RAW", as_of)
    return raw.unionByName(freshness(tables.totals, FACT_TABLE, "ANALYTICS", as_of))


def last_update(totals: DataFrame, layer: str, as_of: datetime) -> DataFrame:
    """``layer_update`` from what each load added to the layer."""
    recent = lookback(totals.filter(F.col("layer") == layer), "load_time", HOUR, as_of)
    return recent.agg(
        F.lit(layer).alias("layer"),
        F.max("load_time").alias("last_update"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
    )


def duplicate_summary(raw: DataFrame) -> DataFrame:
    """Totals, surplus copies and weak signals of raw rows, in one pass."""
    per_key = raw.groupBy(*EVENT_KEY).agg(
        F.count("*").alias("copies"),
        sum_if(F.col("signal_quality") == "WEAK").alias("weak"),
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_raw_events"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
        F.sum("weak").alias("weak_signal_count"),
    )


def orphan_summary(stg: DataFrame, users: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged rows and those without a user or zone, in one pass.

    Rows are counted per (user, zone) before the dimension joins, so a hot user costs
    one joined row. Several current rows of a user count an event several times, as the
    outer join would.
    """
    pairs = stg.groupBy("user_id", "zone_id").agg(F.count("*").alias("n"))
    user_rows = current(users).groupBy("user_id").agg(F.count("*").alias("user_rows"))
    zone_rows = zones.groupBy("zone_id").agg(F.count("*").alias("zone_rows"))
    joined = pairs.join(user_rows, "user_id", "left").join(zone_rows, "zone_id", "left")
    per_user = F.coalesce("user_rows", F.lit(1))
    per_zone = F.coalesce("zone_rows", F.lit(1))
    no_user = F.when(F.col("user_rows").isNull(), F.col("n") * per_zone)
    no_zone = F.when(F.col("zone_rows").isNull(), F.col("n") * per_user)
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_staged_events"),
        F.coalesce(F.sum(no_user), F.lit(0)).alias("orphan_user_count"),
        F.coalesce(F.sum(no_zone), F.lit(0)).alias("orphan_zone_count"),
    )


def data_quality_metrics(tables, as_of: datetime) -> DataFrame:
    """Volumes, duplicates, orphans and weak signals of the last day, one row.

    Each layer is windowed on its own load time and scanned once.
    """
    facts = lookback(tables.facts, "fact_load_time", DAY, as_of)
    totals = one_row(
        duplicate_summary(lookback(tables.raw, "ingestion_time", DAY, as_of)),
        orphan_summary(
            lookback(tables.stg, "staging_time", DAY, as_of), tables.users, tables.zones
        ),
        facts.agg(F.count("*").alias("total_fact_events")),
    )
    raw, staged = F.col("total_raw_events"), F.col("total_staged_events")
    orphans = F.col("orphan_user_count") + F.col("orphan_zone_count")
    return totals.select(
        raw,
        staged,
        "total_fact_events",
        "duplicate_count",
        pct(F.col("duplicate_count"), raw).alias("duplicate_rate_pct"),
        "orphan_user_count",
        "orphan_zone_count",
        pct(orphans, staged).alias("orphan_rate_pct"),
        "weak_signal_count",
        pct(F.col("weak_signal_count"), raw).alias("weak_signal_rate_pct"),
    )


def partition_efficiency(tables, as_of: datetime) -> DataFrame:
    """Share of partitions and rows scanned per monitored table over the last day.

    ``total_gb_scanned_approx`` divides rows, not bytes, by 1024³, as published.
    """
    recent = lookback(tables.pruning, "interval_start_time", DAY, as_of)
    totals = (
        recent.filter(F.col("table_name").isin(RAW_TABLE, FACT_TABLE))
        .groupBy("table_name")
        .agg(
            F.sum("num_queries").alias("query_count"),
            F.sum("partitions_scanned").alias("scanned"),
            F.sum(F.col("partitions_scanned") + F.col("partitions_pruned")).alias("partitions"),
            F.sum("rows_scanned").alias("rows_scanned"),
            F.sum("rows_pruned").alias("rows_pruned"),
            F.sum(F.col("rows_scanned") + F.col("rows_pruned")).alias("rows"),
        )
    )
    scanned, partitions = F.col("scanned"), F.col("partitions")
    scan_pct = F.lit(100.0) * scanned / F.nullif(partitions, F.lit(0))
    return totals.select(
        "table_name",
        "query_count",
        pct(scanned, partitions).alias("avg_scan_ratio_pct"),
        ratio(F.col("rows_scanned"), F.lit(1024**3), 2).alias("total_gb_scanned_approx"),
        pct(F.col("rows_pruned"), F.col("rows")).alias("row_prune_ratio_pct"),
        pruning_band(scan_pct).alias("pruning_efficiency"),
    )


def streaming_costs(tables, as_of: datetime) -> DataFrame:
    """Daily volume and credits over the last 30 days."""
    recent = lookback(tables.migration, "end_time", 30 * DAY, as_of)
    daily = (
        recent.filter(F.col("table_name") == RAW_TABLE)
        .groupBy(F.to_date("end_time").alias("ingestion_date"))
        .agg(
            gib(F.sum("num_bytes_migrated")).alias("gb_ingested"),
            F.sum("num_rows_migrated").alias("rows_ingested"),
            F.sum("credits_used").alias("actual_credits_used"),
        )
    )
    density = F.col("rows_ingested") / F.nullif(F.col("gb_ingested"), F.lit(0.0))
    return daily.withColumn("rows_per_gb", F.round(density, 0)).orderBy(
        newest_first("ingestion_date")
    )


TASK_COLUMNS = (
    "task_name", "state", "scheduled_time", "completed_time", "duration_seconds",
    "error_code", "error_message", "execution_status",
)


def task_execution_history(
    tables,
    as_of: datetime,
    database: str = "DEMO",
    limit: int = 1000,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Newest task runs of the last day. The limit is the published view's result limit
    and applies before the database filter; ``task_runs`` has all runs.

    ``extra`` names further log columns to keep, such as rows_processed.
    """
    recent = lookback(tables.tasks, "scheduled_time", DAY, as_of)
    newest = top_n(recent, limit, newest_first("scheduled_time"))
    return _described_runs(newest, database, extra).orderBy(newest_first("scheduled_time"))


def task_runs(
    tables, as_of: datetime, span: timedelta = DAY, database: str = "DEMO",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Every task run scheduled within ``span``, with the columns of the view above."""
    recent = lookback(tables.tasks, "scheduled_time", span, as_of)
    return _described_runs(recent, database, extra)


def _described_runs(runs: DataFrame, database: str, extra: tuple[str, ...]) -> DataFrame:
    return (
        runs.filter(F.col("database_name") == database)
        .withColumns(
            {
                "task_name": F.col("name"),
                "duration_seconds": seconds_between(
                    F.col("scheduled_time"), F.col("completed_time")
                ),
                "execution_status": execution_band(F.col("state")),
            }
        )
        .select(*TASK_COLUMNS, *extra)
    )


def streaming_client_metrics(tables, as_of: datetime) -> DataFrame:
    """Sessions, volume and credits per client and day over the last 30 days."""
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    return (
        lookback(tables.clients, "start_time", 30 * DAY, as_of)
        .groupBy("client_name", F.to_date("start_time").alias("ingestion_date"))
        .agg(
            F.count("*").alias("session_count"),
            F.sum("credits_used").alias("total_client_credits"),
            gib(F.sum("data_sent_bytes")).alias("total_gb_sent"),
            mib(F.avg("data_sent_bytes")).alias("avg_mb_per_session"),
            F.sum("rows_sent").alias("total_rows_sent"),
            F.avg(duration).alias("avg_session_duration_seconds"),
            F.min("start_time").alias("earliest_session"),
            F.max("end_time").alias("latest_session"),
        )
        .orderBy(newest_first("ingestion_date"), "client_name")
    )
