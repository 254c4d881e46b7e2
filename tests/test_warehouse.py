"""Every view, figure, report and alert on the product's own tables, after two loads."""

from datetime import datetime, timedelta

import pytest
from shared import NOW
from pyspark.sql import functions as F

from gatelog.plans import alerts, kpis, reports, views
from gatelog.streaming import ingest


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory, raw_rows):
    from gatelog.sources.tables import Warehouse

    tables = Warehouse(spark, str(tmp_path_factory.mktemp("wh"))).create(NOW)
    for i in range(2):
        now = ingest.utc_now()
        rows = raw_rows(*[
            {"badge_id": f"B{n}", "ingestion_time": now, "event_timestamp": now} for n in range(5)])
        tables.land(rows.withColumn("reject_reason", F.lit("")), i)
        ingest.run_batch(tables, rows, i)
    return tables


ON_TABLES = [
    *(getattr(views, n) for n in (
        "channel_status", "ingestion_metrics", "active_badges", "end_to_end_latency",
        "data_freshness", "data_quality_metrics", "partition_efficiency", "streaming_costs",
        "task_execution_history", "task_runs", "streaming_client_metrics")),
    *(getattr(alerts, n) for n in (
        "failed_runs", "ingestion_stopped", "volume_drop", "high_orphan_rate",
        "high_duplicate_rate", "high_weak_signal_rate", "quality_violations", "cost_spike",
        "slow_runs", "idle_runs", "rising_unit_cost")),
    *(getattr(kpis, n) for n in ("newest_runs", "task_totals", "task_success", "status_distribution")),
    reports.run_duration_trend, reports.cost_estimate,
]


@pytest.mark.parametrize("function", ON_TABLES, ids=lambda f: f"{f.__module__.split('.')[-1]}.{f.__name__}")
def test_on_tables_and_time(loaded, function):
    function(loaded, ingest.utc_now()).collect()


def test_single_table_reports_and_alerts(loaded):
    now = ingest.utc_now()
    frames = [
        reports.latest_raw_events(loaded), reports.latest_staged(loaded),
        reports.fact_details(loaded), reports.failed_runs(loaded),
        reports.latest_task_runs(loaded, ingest.FACT_TASK, now),
        reports.load_history(reports.landing_loads(loaded.landing, now), now),
        reports.load_history(reports.batch_loads(loaded.batch_log), now),
        reports.compute_credits(loaded.metering, now), reports.idle_credits(loaded.metering, now),
        reports.storage_by_schema(loaded.storage), reports.slowest_queries(loaded.queries, now),
        reports.access_audit(loaded.queries, "u", now),
        reports.latency_distribution(loaded.facts, now),
        reports.channel_table(loaded.batch_log, now),
        reports.runs_by_prefix(loaded, "raw_"),
        alerts.high_latency(loaded.facts, now), alerts.unhealthy_channels(loaded.batch_log, now),
        alerts.missed_targets(loaded.metering, loaded.queries, now, now),
    ]
    for frame in frames:
        frame.collect()


def test_figures_of_two_loads(loaded):
    now = ingest.utc_now()
    status = views.channel_status(loaded, now).first()
    assert (status.total_rows_inserted, status.max_rows_per_insert) == (10, 5)
    sessions = views.streaming_client_metrics(loaded, now).first()
    assert (sessions.session_count, sessions.total_rows_sent) == (2, 10)
    runs = loaded.batch_log.select("run_id").distinct().count()
    assert runs == loaded.batch_log.count() == 4
    keys = sorted(r.event_key for r in loaded.facts.collect())
    assert keys == list(range(1, 11))


def test_keys_go_on_without_the_log_and_with_the_clock_set_back(spark, warehouse, raw_rows, monkeypatch):
    monkeypatch.setattr(ingest, "utc_now", lambda: datetime(2000, 1, 1))
    monkeypatch.setattr(ingest, "log_batch", lambda *args, **fields: None)
    for i in range(3):
        rows = raw_rows(*[
            {"badge_id": f"B{i}-{n}", "event_timestamp": NOW + timedelta(days=n)} for n in range(4)])
        ingest.run_batch(warehouse, rows, i, NOW)
        ingest.run_batch(warehouse, rows, i, NOW)  # a replay takes no keys
    assert sorted(r.event_key for r in warehouse.facts.collect()) == list(range(1, 13))


def test_staged_rows_load_when_their_zone_appears(spark, warehouse, raw_rows):
    zones = spark.createDataFrame(warehouse.zones.collect(), warehouse.zones.schema)
    warehouse.replace_zones(zones.filter("zone_id <> 'ZONE-LOBBY-1'"))
    ingest.run_batch(warehouse, raw_rows({"badge_id": "A"}, {"badge_id": "B"}), 0, NOW)
    ingest.run_batch(warehouse, raw_rows({"badge_id": "C", "zone_id": "nowhere"}), 1, NOW)
    assert warehouse.facts.isEmpty()
    warehouse.replace_zones(zones)
    for _replay in range(2):
        ingest.run_batch(warehouse, raw_rows({"badge_id": "D"}), 2, NOW)
        assert sorted(r.badge_id for r in warehouse.facts.collect()) == ["A", "B", "D"]
    assert warehouse.new_zones()[1] is None
