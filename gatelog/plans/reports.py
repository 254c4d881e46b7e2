"""Operational queries: checks after a load, troubleshooting, usage and audit."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelog.functions.numbers import gib, ratio
from gatelog.functions.times import lookback, seconds_between, truncate
from gatelog.operators.selection import newest_first, top_n
from gatelog.plans import views
from gatelog.plans.views import DAY, HOUR, MINUTE

TASKS = ("raw_to_staging_task", "staging_to_analytics_task")
RUN_COLUMNS = ("name", "state", "scheduled_time", "completed_time")


def _duration():
    return seconds_between(F.col("scheduled_time"), F.col("completed_time"))


def latest_raw_events(tables, n: int = 10) -> DataFrame:
    columns = (
        "badge_id", "user_id", "zone_id", "reader_id", "event_timestamp", "signal_strength",
        "signal_quality", "direction", "ingestion_time",
    )
    rows = tables.newest("raw", n).select(*columns)
    return top_n(rows, n, newest_first("ingestion_time"))


def latest_task_runs(tables, task: str, as_of: datetime, n: int = 5) -> DataFrame:
    runs = lookback(tables.tasks, "scheduled_time", HOUR, as_of).filter(F.col("name") == task)
    columns = runs.select(*RUN_COLUMNS, _duration().alias("duration_sec"))
    return top_n(columns, n, newest_first("scheduled_time"))


def latest_staged(tables, n: int = 10) -> DataFrame:
    columns = ("badge_id", "user_id", "zone_id", "event_timestamp", "staging_time")
    rows = tables.newest("stg", n).select(*columns)
    return top_n(rows, n, newest_first("staging_time"))


def fact_details(tables, n: int = 10) -> DataFrame:
    """Newest facts with user and zone attributes; only n rows reach the joins."""
    newest = tables.newest("facts", n).select(
        "event_timestamp", "badge_id", "user_key", "zone_key", "direction", "signal_strength"
    )
    newest = newest.orderBy(newest_first("event_timestamp"), "badge_id").limit(n)
    users = tables.users.select("user_key", "user_id", "user_name", "department")
    zones = tables.zones.select("zone_key", "zone_id", "zone_name", "zone_type")
    return newest.join(users, "user_key", "left").join(zones, "zone_key", "left").select(
        "badge_id", "user_id", "user_name", "department", "zone_id", "zone_name", "zone_type",
        "event_timestamp", "direction", "signal_strength",
    )


def load_history(
    log: DataFrame, as_of: datetime, table: str = views.RAW_TABLE, span: timedelta = HOUR
) -> DataFrame:
    """Recent loads of one target: file, rows, errors, first error."""
    recent = lookback(log, "last_load_time", span, as_of)
    errors = F.col("error_count")
    status = F.when(errors == 0, "LOADED").when(
        errors < F.col("row_count"), "PARTIALLY_LOADED"
    )
    return recent.filter(F.col("table_name") == table).select(
        "file_name",
        "last_load_time",
        status.otherwise("LOAD_FAILED").alias("status"),
        "row_count",
        "error_count",
        "first_error_message",
    )


def landing_loads(landing: DataFrame, as_of: datetime, span: timedelta = HOUR) -> DataFrame:
    """The landing table as load history: an entry per micro-batch, whose rows share one
    ingestion time, with rejected lines as errors. ``load_history`` takes it."""
    recent = lookback(landing, "ingestion_time", span, as_of)
    rejected = ~F.col("accepted")
    return recent.groupBy(F.col("ingestion_time").alias("last_load_time")).agg(
        F.lit(views.RAW_TABLE).alias("table_name"),
        F.concat(F.lit("batch-"), F.date_format(F.first("ingestion_time"), "yyyyMMddHHmmssSSSSSS"))
        .alias("file_name"),
        F.count("*").alias("row_count"),
        F.count_if(rejected).alias("error_count"),
        F.min(F.when(rejected, F.col("reject_reason"))).alias("first_error_message"),
    )


def batch_loads(batch_log: DataFrame) -> DataFrame:
    """The batch log as load history: one entry per staged batch."""
    staged = batch_log.filter((F.col("name") == TASKS[0]) & (F.col("batch_id") >= 0))
    return staged.select(
        F.lit(views.RAW_TABLE).alias("table_name"),
        F.concat(F.lit("batch-"), F.col("batch_id").cast("string")).alias("file_name"),
        F.col("completed_time").alias("last_load_time"),
        (F.col("rows_processed") + F.col("error_count")).alias("row_count"),
        "error_count",
        F.col("error_message").alias("first_error_message"),
    )


def failed_runs(tables, n: int = 10, run_id: str = "run_id") -> DataFrame:
    columns = (*RUN_COLUMNS, "error_code", "error_message", run_id)
    wanted = F.col("name").isin(*TASKS) & (F.col("state") == "FAILED")
    failed = tables.newest("tasks", n, lambda runs: runs.filter(wanted))
    return top_n(failed.select(*columns), n, newest_first("scheduled_time"))


def compute_credits(
    metering: DataFrame, as_of: datetime, span: timedelta = 7 * DAY,
    warehouse: str = "COMPUTE_WH",
) -> DataFrame:
    recent = lookback(metering, "start_time", span, as_of)
    return (
        recent.filter(F.col("warehouse_name") == warehouse)
        .select(
            "warehouse_name", "start_time", "end_time", "credits_used", "credits_used_compute"
        )
        .orderBy(newest_first("start_time"))
    )


def run_duration_trend(tables, as_of: datetime, span: timedelta = HOUR) -> DataFrame:
    recent = lookback(tables.tasks, "scheduled_time", span, as_of)
    return (
        recent.filter(F.col("name").isin(*TASKS))
        .groupBy("name")
        .agg(
            F.avg(_duration()).alias("avg_duration_sec"),
            F.max(_duration()).alias("max_duration_sec"),
            F.count("*").alias("execution_count"),
        )
    )


def failures_by_message(tables, as_of: datetime) -> DataFrame:
    history = views.task_execution_history(tables, as_of)
    recent = lookback(history, "scheduled_time", DAY, as_of)
    return (
        recent.filter(F.col("state") == "FAILED")
        .groupBy("task_name", "error_message")
        .agg(F.count("*").alias("failure_count"))
        .orderBy(newest_first("failure_count"))
    )


def idle_credits(
    metering: DataFrame, as_of: datetime, warehouse: str = "COMPUTE_WH"
) -> DataFrame:
    """Share of credits used while nothing was computed, per day of the last 30."""
    idle = F.when(F.col("credits_used_compute") == 0, F.col("credits_used")).otherwise(0)
    daily = (
        lookback(metering, "start_time", 30 * DAY, as_of)
        .filter(F.col("warehouse_name") == warehouse)
        .groupBy(truncate("day", F.col("start_time")).alias("day"))
        .agg(
            F.sum("credits_used").alias("total_credits"),
            F.sum(idle.cast("decimal(9,2)")).alias("idle_credits"),
        )
    )
    total = F.nullif(F.col("total_credits"), F.lit(0).cast("decimal(19,2)"))
    share = F.col("idle_credits").cast("double") / total.cast("double") * 100
    return daily.withColumn("idle_percent", share).orderBy(newest_first("day"))


def storage_by_schema(storage: DataFrame, database: str = "DEMO") -> DataFrame:
    used = storage.filter((F.col("table_catalog") == database) & (F.col("active_bytes") > 0))
    total = F.col("active_bytes") + F.col("time_travel_bytes") + F.col("failsafe_bytes")
    return (
        used.groupBy(
            F.col("table_catalog").alias("database_name"),
            F.col("table_schema").alias("schema_name"),
        )
        .agg(
            gib(F.sum("active_bytes")).alias("active_storage_gb"),
            gib(F.sum("time_travel_bytes")).alias("time_travel_storage_gb"),
            gib(F.sum("failsafe_bytes")).alias("failsafe_storage_gb"),
            gib(F.sum(total)).alias("total_storage_gb"),
        )
        .orderBy(newest_first("total_storage_gb"))
    )


def slowest_queries(
    queries: DataFrame, as_of: datetime, n: int = 10, database: str = "DEMO"
) -> DataFrame:
    recent = lookback(queries, "start_time", DAY, as_of).filter(
        (F.col("execution_status") == "SUCCESS") & (F.col("database_name") == database)
    )
    columns = recent.select(
        "query_id",
        "query_text",
        "execution_status",
        (F.col("total_elapsed_ms") / F.lit(1000.0)).alias("execution_time_sec"),
        gib(F.col("bytes_scanned")).alias("gb_scanned"),
        "partitions_scanned",
        "partitions_total",
    )
    return top_n(columns, n, newest_first("execution_time_sec"))


def last_hour_summary(tables, as_of: datetime) -> DataFrame:
    return lookback(tables.raw, "ingestion_time", HOUR, as_of).agg(
        F.lit("Last Hour Summary").alias("metric_group"),
        F.count("*").alias("raw_events"),
        F.countDistinct("badge_id").alias("unique_badges"),
        F.countDistinct("user_id").alias("unique_users"),
        F.avg("signal_strength").alias("avg_signal_strength"),
    )


def ingestion_rate(tables, as_of: datetime, minutes: int = 10) -> DataFrame:
    recent = lookback(tables.raw, "ingestion_time", minutes * MINUTE, as_of)
    return recent.agg(F.count("*").alias("events")).select(
        F.lit(f"Ingestion Rate (Last {minutes} Min)").alias("metric_group"),
        "events",
        ratio(F.col("events"), F.lit(minutes), 6).alias("events_per_minute"),
    )


def task_health(tables, as_of: datetime, n: int = 5) -> DataFrame:
    """Newest runs of the last hour with the rows each processed."""
    history = views.task_execution_history(tables, as_of, extra=("rows_processed",))
    recent = lookback(history, "scheduled_time", HOUR, as_of)
    newest = top_n(recent, n, newest_first("scheduled_time"))
    return newest.select(
        F.lit("Task Health").alias("metric_group"),
        "task_name", "state", "duration_seconds", "rows_processed",
    )


def badges_active_now(tables, as_of: datetime, minutes: int = 5) -> DataFrame:
    return lookback(tables.raw, "ingestion_time", minutes * MINUTE, as_of).agg(
        F.lit(f"Active Badges (Last {minutes} Min)").alias("metric_group"),
        F.countDistinct("badge_id").alias("active_badges"),
    )


def busiest_badges(
    tables, as_of: datetime, n: int = 10, span: timedelta = HOUR
) -> DataFrame:
    recent = lookback(tables.raw, "ingestion_time", span, as_of)
    counts = recent.groupBy("badge_id").agg(F.count("*").alias("event_count"))
    return top_n(counts, n, newest_first("event_count"))


def payload_span(raw: DataFrame, path: str = "$.event_timestamp") -> DataFrame:
    """Event count and first and last event time as stated in the JSON payload."""
    stated = F.get_json_object("raw_json", path).try_cast("timestamp_ntz")
    return raw.agg(
        F.count("*").alias("total_events"),
        F.min(stated).alias("first_event"),
        F.max(stated).alias("last_event"),
    )


def staged_count(tables) -> DataFrame:
    return tables.stg.agg(F.count("*").alias("processed_events"))


def credits_30_days(tables, as_of: datetime) -> DataFrame:
    return views.streaming_costs(tables, as_of).agg(
        F.sum("actual_credits_used").alias("total_credits_last_30_days")
    )


def successful_runs(tables, as_of: datetime) -> DataFrame:
    history = views.task_execution_history(tables, as_of)
    return (
        history.filter(F.col("execution_status") == "SUCCESS")
        .groupBy("task_name")
        .agg(
            F.count("*").alias("executions"), F.avg("duration_seconds").alias("avg_duration")
        )
    )


def client_usage(tables, as_of: datetime) -> DataFrame:
    return (
        views.streaming_client_metrics(tables, as_of)
        .groupBy("client_name")
        .agg(
            F.sum("total_client_credits").alias("credits"),
            F.sum("total_rows_sent").alias("rows"),
        )
    )


def access_audit(queries: DataFrame, user: str, as_of: datetime) -> DataFrame:
    recent = lookback(queries, "start_time", DAY, as_of)
    return (
        recent.filter(F.col("user_name") == user)
        .select("user_name", "client_ip", "event_type", "start_time", "query_text")
        .orderBy(newest_first("start_time"))
    )


def user_listing(tables) -> DataFrame:
    return tables.users.select(
        "user_id", "user_name", "user_type", "department", "clearance_level", "is_active",
        "is_current",
    )


def zone_listing(tables) -> DataFrame:
    return tables.zones.select(
        "zone_id", "building_name", "floor_number", "zone_name", "zone_type",
        "requires_clearance", "is_restricted", "is_monitored",
    )


def runs_by_prefix(tables, prefix: str, n: int = 10) -> DataFrame:
    """Newest runs of tasks whose name starts with ``prefix``, to see how often they ran."""
    wanted = F.col("name").startswith(prefix)
    matching = tables.newest("tasks", n, lambda runs: runs.filter(wanted))
    return top_n(matching.select(*RUN_COLUMNS), n, newest_first("scheduled_time"))


def latency_distribution(
    facts: DataFrame, as_of: datetime, span: timedelta = DAY
) -> DataFrame:
    """Event-to-fact latency of the facts loaded within ``span``, per bucket: count, mean,
    maximum, 95th percentile.

    Counted per whole second first. The percentile interpolates between the two seconds
    around its rank, which running counts over the sorted seconds find; no buffer holds a
    bucket's seconds.
    """
    recent = lookback(facts, "fact_load_time", span, as_of)
    seconds = seconds_between(F.col("event_timestamp"), F.col("fact_load_time"))
    per_second = recent.groupBy(seconds.alias("s")).agg(F.count("*").alias("n"))
    s, n = F.col("s"), F.col("n")
    bucket = (
        F.when(s < 60, "0-60s").when(s < 120, "60-120s").when(s < 180, "120-180s")
        .when(s < 300, "180-300s").otherwise("300s+")
    )
    bucketed = per_second.withColumn("lag_bucket", bucket)
    totals = bucketed.groupBy("lag_bucket").agg(
        F.sum("n").alias("event_count"),
        (F.sum(s * n) / F.sum("n")).alias("avg_latency_seconds"),
        F.max("s").alias("max_latency_seconds"),
    )
    # position of the percentile among 0 … count - 1, and the seconds on both its sides
    counted = running_counts(bucketed, ["lag_bucket"], "s", "n").join(totals, "lag_bucket")
    position = (F.col("event_count") - 1) * F.lit(0.95)
    low, high = F.floor(position), F.ceil(position)
    at = lambda rank: F.max(
        F.when((F.col("before") <= rank) & (rank < F.col("before") + n), s)
    )
    around = counted.groupBy(
        "lag_bucket", "event_count", "avg_latency_seconds", "max_latency_seconds"
    ).agg(at(low).alias("_low"), at(high).alias("_high"))
    share = position - F.floor(position)
    p95 = F.col("_low") + (F.col("_high") - F.col("_low")) * share
    return around.select(
        "lag_bucket", "event_count", "avg_latency_seconds", "max_latency_seconds",
        F.round(p95, 6).alias("p95_latency_seconds"),
    )


def running_counts(
    df: DataFrame, keys: list[str], value: str, count: str, width: int = 3600
) -> DataFrame:
    """Adds ``before``: the sum of ``count`` over the smaller values of the same key.

    Values are summed in ranges of ``width`` first, so that a window holds the values of
    one range, or one row per range, and never all values of a key.
    """
    ranged = df.withColumn("_range", F.floor(F.col(value) / width))
    sums = ranged.groupBy(*keys, "_range").agg(F.sum(count).alias("_sum"))
    ranges = Window.partitionBy(*keys).orderBy("_range")
    within = Window.partitionBy(*keys, "_range").orderBy(value)
    upto = (Window.unboundedPreceding, -1)
    shifts = sums.select(
        *keys, "_range",
        F.coalesce(F.sum("_sum").over(ranges.rowsBetween(*upto)), F.lit(0)).alias("_shift"),
    )
    own = F.coalesce(F.sum(count).over(within.rowsBetween(*upto)), F.lit(0))
    placed = ranged.withColumn("_own", own).join(shifts, [*keys, "_range"])
    return placed.withColumn("before", F.col("_own") + F.col("_shift")).drop(
        "_own", "_range", "_shift"
    )


def channel_table(log: DataFrame, as_of: datetime, closed_after: timedelta = DAY) -> DataFrame:
    """One row per task of the batch log, as a channel.

    ERROR if its newest run failed, CLOSED if it has been silent for ``closed_after``,
    else OPEN.
    """
    order = F.struct("scheduled_time", "completed_time", "state")
    channels = log.groupBy(F.col("name").alias("channel_name")).agg(
        F.max_by("state", order).alias("_state"),
        F.max("completed_time").alias("last_poll_time"),
        F.sum("rows_processed").alias("rows_ingested"),
        F.sum("bytes_processed").alias("bytes_ingested"),
        F.count_if(F.col("state") == "FAILED").alias("error_count"),
    )
    silent = views.age(F.col("last_poll_time"), as_of) > closed_after.total_seconds()
    status = F.when(F.col("_state") == "FAILED", "ERROR").when(silent, "CLOSED")
    return channels.select(
        "channel_name",
        status.otherwise("OPEN").alias("status"),
        "last_poll_time", "rows_ingested", "bytes_ingested", "error_count",
    )


def cost_estimate(
    tables, as_of: datetime, credits_per_gb: float = 0.06, credits_per_hour: float = 1.0
) -> DataFrame:
    """Estimated daily credits: volume at a rate per GB plus run time at a size per hour."""
    gb_to_credits = F.col("gb_ingested") * F.lit(credits_per_gb)
    volume = views.streaming_costs(tables, as_of).select(
        F.col("ingestion_date").alias("day"),
        gb_to_credits.alias("ingest_credits"),
        F.lit(0).cast("bigint").alias("seconds"),
    )
    runs = lookback(tables.tasks, "scheduled_time", 30 * DAY, as_of).select(
        F.to_date("scheduled_time").alias("day"),
        F.lit(0.0).alias("ingest_credits"),
        _duration().alias("seconds"),
    )
    daily = volume.unionByName(runs).groupBy("day").agg(
        F.max("ingest_credits").alias("ingest_credits"), F.sum("seconds").alias("run_seconds")
    )
    compute = F.col("run_seconds") / F.lit(3600.0) * F.lit(credits_per_hour)
    return daily.select(
        "day",
        "ingest_credits",
        compute.alias("compute_credits"),
        (F.col("ingest_credits") + compute).alias("total_credits"),
    ).orderBy(newest_first("day"))
