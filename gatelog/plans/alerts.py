"""Alert rules: each returns the violating rows, none when all is well."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelog.functions.times import lookback, ntz, truncate
from gatelog.operators.sequences import change_pct, hour_spine, runs, with_previous
from gatelog.plans import reports, views
from gatelog.plans.views import DAY


def failed_runs(tables, as_of: datetime, span: timedelta = DAY) -> DataFrame:
    return views.task_runs(tables, as_of, span).filter(F.col("state") == "FAILED")


def ingestion_stopped(tables, as_of: datetime, hours: int = 2) -> DataFrame:
    """Spans of more than ``hours`` consecutive hours without an event in the last day."""
    spine = hour_spine(tables.raw.sparkSession, as_of - DAY, as_of)
    seen = views.ingestion_metrics(tables, as_of).select("ingestion_hour", "event_count")
    counted = spine.join(seen, spine["hour"] == seen["ingestion_hour"], "left")
    idle = runs(counted, [], [F.col("hour")], F.col("event_count").isNull())
    return (
        idle.groupBy("run")
        .agg(
            F.min("hour").alias("first_hour"),
            F.max("hour").alias("last_hour"),
            F.count("*").alias("idle_hours"),
        )
        .filter(F.col("idle_hours") > hours)
        .drop("run")
    )


def volume_drop(tables, as_of: datetime, threshold: float = 50) -> DataFrame:
    """Hours whose count fell by more than ``threshold`` percent against the one before."""
    hourly = views.ingestion_metrics(tables, as_of).select("ingestion_hour", "event_count")
    compared = with_previous(hourly, "ingestion_hour", "event_count")
    change = change_pct(F.col("event_count"), F.col("previous_event_count"))
    return compared.withColumn("change_pct", change).filter(
        F.col("change_pct") < -threshold
    )


def _quality_above(tables, as_of: datetime, column: str, threshold: float) -> DataFrame:
    quality = views.data_quality_metrics(tables, as_of)
    return quality.filter(F.col(column) > threshold).select(
        F.lit(column).alias("rule"),
        F.col(column).alias("value"),
        F.lit(float(threshold)).alias("threshold"),
    )


def high_orphan_rate(tables, as_of: datetime, threshold: float = 5) -> DataFrame:
    return _quality_above(tables, as_of, "orphan_rate_pct", threshold)


def high_duplicate_rate(tables, as_of: datetime, threshold: float = 10) -> DataFrame:
    return _quality_above(tables, as_of, "duplicate_rate_pct", threshold)


def high_weak_signal_rate(tables, as_of: datetime, threshold: float = 20) -> DataFrame:
    return _quality_above(tables, as_of, "weak_signal_rate_pct", threshold)


def quality_violations(
    tables, as_of: datetime, orphans: float = 5, duplicates: float = 10, weak: float = 20
) -> DataFrame:
    """All three quality rules from one evaluation of the metrics."""
    limits = {
        "orphan_rate_pct": orphans,
        "duplicate_rate_pct": duplicates,
        "weak_signal_rate_pct": weak,
    }
    limit = F.lit(None).cast("double")
    for name, value in limits.items():
        limit = F.when(F.col("rule") == name, float(value)).otherwise(limit)
    return (
        views.data_quality_metrics(tables, as_of)
        .unpivot([], list(limits), "rule", "value")
        .withColumn("threshold", limit)
        .filter(F.col("value") > F.col("threshold"))
    )


def high_latency(
    facts: DataFrame, as_of: datetime, average: float = 180, maximum: float = 300,
    span: timedelta = DAY,
) -> DataFrame:
    """Lag buckets of the facts loaded within ``span`` that exceed a limit."""
    over = (F.col("avg_latency_seconds") > average) | (F.col("max_latency_seconds") > maximum)
    return reports.latency_distribution(facts, as_of, span).filter(over)


def cost_spike(tables, as_of: datetime, threshold: float = 50) -> DataFrame:
    """Days whose credits rose by more than ``threshold`` percent."""
    daily = views.streaming_costs(tables, as_of).select(
        "ingestion_date", "actual_credits_used"
    )
    compared = with_previous(daily, "ingestion_date", "actual_credits_used")
    change = change_pct(
        F.col("actual_credits_used"), F.col("previous_actual_credits_used")
    )
    return compared.withColumn("change_pct", change).filter(F.col("change_pct") > threshold)


def slow_runs(
    tables, as_of: datetime, seconds: int = 30, span: timedelta = DAY
) -> DataFrame:
    runs_in_span = views.task_runs(tables, as_of, span)
    return runs_in_span.filter(F.col("duration_seconds") > seconds)


def idle_runs(
    tables, as_of: datetime, count: int = 5, span: timedelta = DAY
) -> DataFrame:
    """Tasks with more than ``count`` consecutive runs that processed no row."""
    history = views.task_runs(tables, as_of, span, extra=("rows_processed", "run_id"))
    order = [F.col("scheduled_time"), F.col("run_id"), F.col("completed_time")]
    idle = runs(history, ["task_name"], order, F.col("rows_processed") == 0)
    return (
        idle.groupBy("task_name", "run")
        .agg(
            F.min("scheduled_time").alias("first_run"),
            F.max("scheduled_time").alias("last_run"),
            F.count("*").alias("idle_runs"),
        )
        .filter(F.col("idle_runs") > count)
        .drop("run")
    )


def rising_unit_cost(tables, as_of: datetime) -> DataFrame:
    """Days whose credits per row exceed the previous day's, compared without division."""
    daily = views.streaming_costs(tables, as_of).select(
        "ingestion_date", "rows_ingested", "actual_credits_used"
    )
    compared = with_previous(
        with_previous(daily, "ingestion_date", "rows_ingested"),
        "ingestion_date", "actual_credits_used",
    )
    now = F.col("actual_credits_used") * F.col("previous_rows_ingested")
    before = F.col("previous_actual_credits_used") * F.col("rows_ingested")
    return compared.filter(now > before)


def unhealthy_channels(log: DataFrame, as_of: datetime, silent_seconds: int = 300) -> DataFrame:
    silent = views.age(F.col("last_poll_time"), as_of) > silent_seconds
    stalled = (F.col("status") == "OPEN") & silent
    channels = reports.channel_table(log, as_of)
    return channels.filter((F.col("status") == "ERROR") | stalled)


def storage_growth(
    storage_days: DataFrame, raw: DataFrame, as_of: datetime, threshold: float = 10,
    span: timedelta = 30 * DAY,
) -> DataFrame:
    """Days within ``span`` whose storage grew by more than ``threshold`` percent while
    events did not.

    ``storage_days`` holds one ``(day, total_bytes)`` row per day. The span begins with a
    whole day, so that no day is compared with a part of one.
    """
    oldest = datetime.combine((as_of - span).date(), datetime.min.time())
    storage_days = storage_days.filter(F.col("day") >= ntz(oldest))
    events = lookback(raw, "ingestion_time", as_of - oldest, as_of).groupBy(truncate("day", F.col("ingestion_time")).alias("day")).agg(
        F.count("*").alias("event_count")
    )
    daily = storage_days.join(events, "day")
    compared = with_previous(
        with_previous(daily, "day", "total_bytes"), "day", "event_count"
    )
    grown = compared.select(
        "day",
        change_pct(F.col("total_bytes"), F.col("previous_total_bytes")).alias("storage_pct"),
        change_pct(F.col("event_count"), F.col("previous_event_count")).alias("event_pct"),
    )
    return grown.filter((F.col("storage_pct") > threshold) & (F.col("event_pct") <= threshold))


def missed_targets(
    metering: DataFrame, queries: DataFrame, as_of: datetime, queries_as_of: datetime,
    idle: float = 10, scanned: float = 0.1, seconds: float = 5,
) -> DataFrame:
    """Idle days, unpruned scans and slow queries beyond their targets."""

    def rows(df: DataFrame, target: str, subject, value, limit: float) -> DataFrame:
        missed = df.select(
            F.lit(target).alias("target"),
            subject.cast("string").alias("subject"),
            value.alias("value"),
        )
        return missed.filter(F.col("value") >= limit)

    slowest = reports.slowest_queries(queries, queries_as_of)
    share = F.col("partitions_scanned") / F.nullif(F.col("partitions_total"), F.lit(0))
    days = reports.idle_credits(metering, as_of)
    day = F.to_date("day")
    return (
        rows(days, "idle_percent", day, F.col("idle_percent"), idle)
        .unionByName(rows(slowest, "scan_share", F.col("query_id"), share, scanned))
        .unionByName(
            rows(slowest, "seconds", F.col("query_id"), F.col("execution_time_sec"), seconds)
        )
    )
