"""Edge cases of the monitoring views: empty tables, idle layers, zero denominators."""

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from shared import NOW
from pyspark.sql import functions as F

from gatelog import schemas
from gatelog.catalog.feeds import AS_OF as feeds_as_of
from gatelog.operators import facts
from gatelog.plans import alerts, kpis, reports, views
from gatelog.sources.seeds import seed_users, seed_zones

HOUR = timedelta(hours=1)


@pytest.fixture(scope="module")
def empty(spark):
    def table(schema):
        return spark.createDataFrame([], schema)

    return SimpleNamespace(
        raw=table(schemas.RAW), stg=table(schemas.STAGING), facts=table(schemas.FACTS),
        users=seed_users(spark, NOW), zones=seed_zones(spark, NOW),
        tasks=table(schemas.BATCH_LOG), totals=table(schemas.TOTALS),
        migration=table(
            "table_name string, end_time timestamp_ntz, num_rows_migrated bigint, "
            "num_bytes_migrated bigint, credits_used decimal(18,6)"),
    )


def test_empty_tables(empty):
    assert views.ingestion_metrics(empty, NOW).isEmpty()
    assert views.active_badges(empty, NOW).isEmpty()
    assert views.channel_status(empty, NOW).isEmpty()
    latency = views.end_to_end_latency(empty, NOW).collect()
    assert [(r.layer, r.row_count, r.last_update, r.health_status) for r in latency] == [
        (layer, 0, None, "HEALTHY") for layer in ("RAW", "STAGING", "ANALYTICS")]
    assert {(r.total_rows, r.rows_last_hour) for r in
            views.data_freshness(empty, NOW).collect()} == {(0, None)}
    quality = views.data_quality_metrics(empty, NOW).first()
    assert (quality.total_raw_events, quality.total_staged_events, quality.duplicate_count,
            quality.orphan_user_count) == (0, 0, 0, 0)
    assert quality.weak_signal_count is None and quality.duplicate_rate_pct is None
    overview = kpis.overview(empty, NOW).first()
    assert (overview.events_last_hour, overview.total_rows_stored) == (None, 0)
    assert alerts.quality_violations(empty, NOW).isEmpty()


def test_idle_layer_can_be_reported(empty):
    rows = views.end_to_end_latency(empty, NOW, null_status="IDLE").collect()
    assert {r.health_status for r in rows} == {"IDLE"}


def test_health_by_age(spark, raw_rows, empty):
    for seconds, status in ((60, "HEALTHY"), (200, "WARNING"), (400, "STALE")):
        raw = raw_rows({"ingestion_time": NOW - timedelta(seconds=seconds)})
        tables = SimpleNamespace(**{**vars(empty), "raw": raw})
        first = views.end_to_end_latency(tables, NOW).first()
        assert (first.seconds_since_update, first.health_status) == (seconds, status)


def test_lookback_has_an_inclusive_lower_and_no_upper_bound(raw_rows, empty):
    stamps = [NOW - timedelta(days=1, microseconds=1), NOW - timedelta(days=1), NOW + HOUR]
    raw = raw_rows(*[{"ingestion_time": s, "badge_id": str(i)} for i, s in enumerate(stamps)])
    tables = SimpleNamespace(**{**vars(empty), "raw": raw})
    assert {r.badge_id for r in views.active_badges(tables, NOW).collect()} == {"1", "2"}


def test_hourly_average_includes_the_missing_default(spark, raw_rows, empty):
    from decimal import Decimal

    raw = raw_rows(*[{"signal_strength": Decimal(s)} for s in (-999, -50)])
    tables = SimpleNamespace(**{**vars(empty), "raw": raw})
    row = views.ingestion_metrics(tables, NOW).first()
    assert (row.avg_signal_strength, row.entry_count, row.exit_count) == (-524.5, 2, 0)


def test_orphans_count_like_the_outer_join(spark, raw_rows, empty):
    doubled = empty.users.unionByName(empty.users.filter("user_id = 'USR-001'"))
    staged = facts.stage_batch(raw_rows(
        {}, {"badge_id": "B2", "zone_id": "nowhere"}, {"badge_id": "B3", "user_id": "nobody"},
    ))
    row = views.orphan_summary(staged, doubled, empty.zones).first()
    # the unknown zone's event joins both current rows of its user
    assert tuple(row) == (3, 1, 2)


def test_zero_denominators(spark, empty):
    pruning = spark.createDataFrame(
        [("RAW_BADGE_EVENTS", NOW, 1, 0, 0, 0, 0)],
        "table_name string, interval_start_time timestamp_ntz, num_queries bigint, "
        "partitions_scanned bigint, partitions_pruned bigint, rows_scanned bigint, "
        "rows_pruned bigint")
    row = views.partition_efficiency(SimpleNamespace(pruning=pruning), NOW).first()
    assert (row.avg_scan_ratio_pct, row.row_prune_ratio_pct, row.pruning_efficiency) == (
        None, None, "POOR")
    migration = empty.migration.unionByName(spark.createDataFrame(
        [("RAW_BADGE_EVENTS", NOW, 0, 0, None)], empty.migration.schema))
    tables = SimpleNamespace(migration=migration)
    assert views.streaming_costs(tables, NOW).first().rows_per_gb is None
    assert kpis.cost_totals(tables, NOW).first().avg_credits_per_gb == 0
    idle = spark.createDataFrame(
        [("COMPUTE_WH", NOW, None, None)],
        "warehouse_name string, start_time timestamp_ntz, credits_used decimal(9,2), "
        "credits_used_compute decimal(9,2)").fillna(0)
    assert reports.idle_credits(idle.withColumns({
        "credits_used": F.lit(0).cast("decimal(9,2)"),
        "credits_used_compute": F.lit(0).cast("decimal(9,2)")}), NOW).first().idle_percent is None


def test_the_task_limit_applies_before_the_database_filter(spark):
    rows = [(f"t{i}", "DEMO" if i < 5 else "OTHER", "FAILED", NOW - i * HOUR) for i in range(9)]
    tasks = spark.createDataFrame(
        rows, "name string, database_name string, state string, scheduled_time timestamp_ntz"
    ).withColumns({
        "completed_time": F.col("scheduled_time"), "error_code": F.lit("1"),
        "error_message": F.lit("x"), "rows_processed": F.lit(0)})
    tables = SimpleNamespace(tasks=tasks)
    assert views.task_execution_history(tables, NOW, limit=3).count() == 3
    assert views.task_execution_history(tables, NOW, database="OTHER", limit=6).count() == 1


def test_ingestion_gap_alert(raw_rows):
    as_of = datetime(2024, 1, 31, 10, 30)
    hours = [h for h in range(25) if h not in (3, 4, 5, 9, 10)]
    stamps = [as_of - timedelta(days=1) + h * HOUR for h in hours]
    raw = raw_rows(*[{"ingestion_time": s} for s in stamps])
    (gap,) = alerts.ingestion_stopped(SimpleNamespace(raw=raw), as_of).collect()
    assert (gap.first_hour, gap.idle_hours) == (datetime(2024, 1, 30, 13), 3)


def test_channel_states(spark):
    def log(*rows):
        return spark.createDataFrame(
            rows, "name string, state string, scheduled_time timestamp_ntz, "
            "completed_time timestamp_ntz, rows_processed bigint, bytes_processed bigint")

    table = log(
        ("ok", "SUCCEEDED", NOW, NOW, 1, 10), ("ok", "FAILED", NOW - HOUR, NOW - HOUR, 0, 0),
        ("bad", "FAILED", NOW, NOW, 0, 0),
        ("stalled", "SUCCEEDED", NOW - HOUR, NOW - HOUR, 5, 50),
        ("old", "SUCCEEDED", NOW - 48 * HOUR, NOW - 48 * HOUR, 5, 50),
    )
    states = {r.channel_name: (r.status, r.error_count) for r in
              reports.channel_table(table, NOW).collect()}
    assert states == {"ok": ("OPEN", 1), "bad": ("ERROR", 1), "stalled": ("OPEN", 0),
                      "old": ("CLOSED", 0)}
    unhealthy = alerts.unhealthy_channels(table, NOW)
    assert {r.channel_name for r in unhealthy.collect()} == {"bad", "stalled"}


def test_latency_percentile_matches_the_one_of_all_rows(spark, feeds):
    span = timedelta(days=30)
    got = reports.latency_distribution(feeds.facts, feeds_as_of, span).collect()
    seconds = feeds.facts.selectExpr(
        "unix_seconds(cast(fact_load_time AS timestamp)) "
        "- unix_seconds(cast(event_timestamp AS timestamp)) AS s")
    slow = seconds.filter("s >= 300").selectExpr("percentile(s, 0.95) AS p", "count(*) AS n")
    want = slow.first()
    row = next(r for r in got if r.lag_bucket == "300s+")
    assert (row.event_count, row.p95_latency_seconds) == (want.n, round(want.p, 6))


def test_only_recent_facts_count_as_latency(feeds):
    later = feeds_as_of + timedelta(days=60)
    assert reports.latency_distribution(feeds.facts, later).collect() == []
