"""The figures under each dashboard page, computed on the monitoring views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.functions.labels import health_color, humanize_seconds
from gatelog.operators.selection import newest_first, top_n
from gatelog.plans import views


def percent_of_rows(condition: Column) -> Column:
    return F.lit(100.0) * F.count_if(condition) / F.nullif(F.count("*"), F.lit(0))


def exact_mean(column: Column) -> Column:
    """Mean of a two-decimal figure, the same whatever the order of rows."""
    return F.avg(column.cast("decimal(18,2)")).cast("double")


def overview(tables, as_of: datetime) -> DataFrame:
    """Rows and credits of the last hour, landing status and age, rows stored."""
    channel = views.channel_status(tables, as_of).agg(
        F.max("total_rows_inserted").alias("events_last_hour"),
        F.max("total_credits_used").alias("credits_last_hour"),
    )
    landing = views.with_health(
        views.last_update(tables.totals, "RAW", as_of), as_of
    ).select(
        F.col("health_status").alias("raw_status"),
        humanize_seconds(F.col("seconds_since_update")).alias("raw_age"),
    )
    stored = views.data_freshness(tables, as_of).agg(
        F.sum("total_rows").alias("total_rows_stored")
    )
    return views.one_row(channel, landing, stored)


def layer_cards(tables, as_of: datetime) -> DataFrame:
    return views.end_to_end_latency(tables, as_of).select(
        "layer",
        "health_status",
        health_color(F.col("health_status")).alias("color"),
        humanize_seconds(F.col("seconds_since_update")).alias("last_update_age"),
        "row_count",
    )


def freshness_table(tables, as_of: datetime) -> DataFrame:
    return views.data_freshness(tables, as_of).select(
        "table_name",
        "last_event_timestamp",
        humanize_seconds(F.col("event_age_seconds")).alias("event_age"),
        humanize_seconds(F.col("ingestion_age_seconds")).alias("ingestion_age"),
        "total_rows",
        "rows_last_hour",
    )


def newest_hours(tables, as_of: datetime, n: int = 24) -> DataFrame:
    metrics = views.ingestion_metrics(tables, as_of)
    return metrics.orderBy(newest_first("ingestion_hour")).limit(n)


def ingestion_totals(tables, as_of: datetime) -> DataFrame:
    """Over the newest 24 hours: the busiest hour's badges, an unweighted signal mean."""
    return newest_hours(tables, as_of).agg(
        F.sum("event_count").alias("total_events"),
        F.avg("event_count").alias("avg_events_per_hour"),
        F.max("unique_badges").alias("unique_badges"),
        exact_mean(F.col("avg_signal_strength")).alias("avg_signal_strength"),
    )


def entry_exit_series(tables, as_of: datetime) -> DataFrame:
    hours = newest_hours(tables, as_of).select(
        "ingestion_hour", F.col("entry_count").alias("Entry"), F.col("exit_count").alias("Exit")
    )
    return hours.unpivot(
        "ingestion_hour", ["Entry", "Exit"], "direction", "event_count"
    ).orderBy("ingestion_hour", "direction")


def volume_series(tables, as_of: datetime) -> DataFrame:
    return (
        newest_hours(tables, as_of)
        .select("ingestion_hour", "event_count", "weak_signal_pct")
        .orderBy("ingestion_hour")
    )


def cost_totals(tables, as_of: datetime) -> DataFrame:
    """Sums over the newest 30 days; credits per GB is 0 when nothing was ingested."""
    days = views.streaming_costs(tables, as_of).limit(30)
    totals = days.agg(
        F.sum("actual_credits_used").alias("total_credits"),
        F.sum("gb_ingested").alias("total_gb"),
        F.sum("rows_ingested").alias("total_rows"),
    )
    gb = F.col("total_gb")
    per_gb = F.when(gb > 0, F.col("total_credits").cast("double") / gb).otherwise(0.0)
    return totals.withColumn("avg_credits_per_gb", per_gb)


def newest_runs(tables, as_of: datetime, n: int = 50) -> DataFrame:
    """The newest runs of the task history; ties by the remaining columns."""
    history = views.task_execution_history(tables, as_of, extra=("run_id",))
    return top_n(history, n, newest_first("scheduled_time"))


def _succeeded() -> Column:
    return F.col("execution_status") == "SUCCESS"


def task_totals(tables, as_of: datetime) -> DataFrame:
    return newest_runs(tables, as_of).agg(
        F.count("*").alias("total_executions"),
        percent_of_rows(_succeeded()).alias("success_rate"),
        F.avg("duration_seconds").alias("avg_duration"),
        F.count_if(F.col("execution_status") == "FAILED").alias("failed_count"),
    )


def task_success(tables, as_of: datetime) -> DataFrame:
    return newest_runs(tables, as_of).groupBy("task_name").agg(
        percent_of_rows(_succeeded()).alias("success_rate"),
        F.avg("duration_seconds").alias("avg_duration"),
    )


def status_distribution(tables, as_of: datetime) -> DataFrame:
    counts = newest_runs(tables, as_of).groupBy("execution_status")
    return counts.agg(F.count("*").alias("runs")).orderBy(newest_first("runs"))


def recent_executions(tables, as_of: datetime, n: int = 20) -> DataFrame:
    """Of the newest 50 runs, failures first: status ascending, then newest."""
    runs = newest_runs(tables, as_of)
    ordered = top_n(
        runs, n, F.col("execution_status").asc_nulls_last(), newest_first("scheduled_time")
    )
    return ordered.select(
        "task_name", "scheduled_time", "duration_seconds", "execution_status", "error_message"
    )


def pruning_totals(tables, as_of: datetime) -> DataFrame:
    return views.partition_efficiency(tables, as_of).agg(
        F.sum("query_count").alias("total_queries"),
        exact_mean(F.col("avg_scan_ratio_pct")).alias("avg_scan_ratio"),
        F.sum(F.col("total_gb_scanned_approx").cast("decimal(18,2)"))
        .cast("double")
        .alias("total_gb_scanned"),
        exact_mean(F.col("row_prune_ratio_pct")).alias("avg_prune_ratio"),
    )


def newest_client_days(tables, as_of: datetime, n: int = 30) -> DataFrame:
    metrics = views.streaming_client_metrics(tables, as_of)
    return metrics.orderBy(newest_first("ingestion_date"), "client_name").limit(n)


def client_totals(tables, as_of: datetime) -> DataFrame:
    return newest_client_days(tables, as_of).agg(
        F.sum("total_client_credits").alias("total_client_credits"),
        F.sum("total_gb_sent").alias("total_gb_sent"),
        F.sum("total_rows_sent").alias("total_rows_sent"),
        F.sum("session_count").alias("total_sessions"),
    )


def client_series(tables, as_of: datetime) -> DataFrame:
    return (
        newest_client_days(tables, as_of)
        .select(
            "client_name",
            "ingestion_date",
            "total_client_credits",
            "total_rows_sent",
            "avg_session_duration_seconds",
            "session_count",
        )
        .orderBy("ingestion_date", "client_name")
    )
