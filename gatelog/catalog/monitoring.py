"""Monitoring views (V) and dashboard figures (K)."""

from __future__ import annotations

from gatelog.catalog import expected as x
from gatelog.catalog.feeds import AS_OF, AS_OF_PRUNE, AS_OF_TASKS, AS_OF_TODAY
from gatelog.catalog.incremental import ONE_BATCH, ONE_BATCH_FACTS, loaded
from gatelog.catalog.registry import query
from gatelog.plans import kpis, views
from gatelog.streaming import ingest


@query("v01_channel_status", "SELECT * FROM v_channel_status")
def _(t):
    return views.channel_status(t, AS_OF)


def _on_warehouse(t, purpose: str):
    """The product's own tables after landing and loading every event, and the time now."""
    return loaded(t, purpose), ingest.utc_now()


@query("v01_on_warehouse", """
SELECT 'RAW_BADGE_EVENTS' AS pipe_name, count(*) AS total_rows_inserted FROM raw_events""")
def _(t):
    tables, now = _on_warehouse(t, "v01")
    return views.channel_status(tables, now).select("pipe_name", "total_rows_inserted")


@query("v04_on_warehouse", f"""
SELECT 'RAW' AS layer, count(*) AS row_count FROM raw_events
UNION ALL SELECT 'STAGING', count(*) FROM {ONE_BATCH}
UNION ALL SELECT 'ANALYTICS', count(*) FROM ({ONE_BATCH_FACTS})""")
def _(t):
    tables, now = _on_warehouse(t, "v04")
    return views.end_to_end_latency(tables, now).select("layer", "row_count")


@query("v05_on_warehouse", f"""
SELECT 'RAW_BADGE_EVENTS' AS table_name, max(event_timestamp) AS last_event_timestamp,
  count(*) AS total_rows, count(*) AS rows_last_hour FROM raw_events
UNION ALL SELECT 'FCT_ACCESS_EVENTS', max(event_timestamp), count(*), count(*)
FROM ({ONE_BATCH_FACTS})""")
def _(t):
    tables, now = _on_warehouse(t, "v05")
    return views.data_freshness(tables, now).select(
        "table_name", "last_event_timestamp", "total_rows", "rows_last_hour")


@query("k01_on_warehouse", f"""
SELECT r.n AS events_last_hour, 'HEALTHY' AS raw_status, r.n + f.n AS total_rows_stored
FROM (SELECT count(*) AS n FROM raw_events) r, (SELECT count(*) AS n FROM ({ONE_BATCH_FACTS})) f""")
def _(t):
    tables, now = _on_warehouse(t, "k01")
    return kpis.overview(tables, now).select(
        "events_last_hour", "raw_status", "total_rows_stored")


@query("k03_on_warehouse", f"""
SELECT 'RAW_BADGE_EVENTS' AS table_name, max(event_timestamp) AS last_event_timestamp,
  count(*) AS total_rows, count(*) AS rows_last_hour FROM raw_events
UNION ALL SELECT 'FCT_ACCESS_EVENTS', max(event_timestamp), count(*), count(*)
FROM ({ONE_BATCH_FACTS})""")
def _(t):
    tables, now = _on_warehouse(t, "k03")
    return kpis.freshness_table(tables, now).select(
        "table_name", "last_event_timestamp", "total_rows", "rows_last_hour")


@query("v06_on_warehouse", f"""
SELECT r.n AS total_raw_events, s.n AS total_staged_events, f.n AS total_fact_events,
  r.n - s.n AS duplicate_count
FROM (SELECT count(*) AS n FROM raw_events) r, (SELECT count(*) AS n FROM {ONE_BATCH}) s,
  (SELECT count(*) AS n FROM ({ONE_BATCH_FACTS})) f""")
def _(t):
    tables, now = _on_warehouse(t, "v06")
    return views.data_quality_metrics(tables, now).select(
        "total_raw_events", "total_staged_events", "total_fact_events", "duplicate_count")


@query("v08_on_warehouse", "SELECT count(*) AS rows_ingested FROM raw_events")
def _(t):
    tables, now = _on_warehouse(t, "v08")
    return views.streaming_costs(tables, now).select("rows_ingested")


@query("v09_on_warehouse", f"""
SELECT 'raw_to_staging_task' AS task_name, 'SUCCESS' AS execution_status,
  count(*) AS rows_processed FROM {ONE_BATCH}
UNION ALL SELECT 'staging_to_analytics_task', 'SUCCESS', count(*) FROM ({ONE_BATCH_FACTS})""")
def _(t):
    tables, now = _on_warehouse(t, "v09")
    return views.task_execution_history(tables, now, extra=("rows_processed",)).select(
        "task_name", "execution_status", "rows_processed")


@query("v10_on_warehouse", """
SELECT 'raw_to_staging_task' AS client_name, cast(1 AS bigint) AS session_count,
  count(*) AS total_rows_sent FROM raw_events""")
def _(t):
    tables, now = _on_warehouse(t, "v10")
    return views.streaming_client_metrics(tables, now).select(
        "client_name", "session_count", "total_rows_sent")


@query("v02_ingestion_metrics", "SELECT * FROM v_ingestion_metrics")
def _(t):
    return views.ingestion_metrics(t, AS_OF)


@query("v03_active_badges", f"""
SELECT l.badge_id, l.user_id, u.user_name, l.zone_id AS last_zone,
  l.event_timestamp AS last_seen, c.event_count_today
FROM (SELECT * FROM raw_events WHERE ingestion_time >= {x.AS_OF_TODAY} - INTERVAL '1' DAY
  QUALIFY row_number() OVER (PARTITION BY badge_id
    ORDER BY event_timestamp DESC, ingestion_time DESC, seq DESC) = 1) l
LEFT JOIN dim_users u ON l.user_id = u.user_id AND u.is_current
LEFT JOIN (SELECT badge_id,
    count(*) FILTER (cast(event_timestamp AS date) = cast({x.AS_OF_TODAY} AS date))
      AS event_count_today
  FROM raw_events WHERE ingestion_time >= {x.AS_OF_TODAY} - INTERVAL '1' DAY
  GROUP BY badge_id) c ON l.badge_id = c.badge_id""")
def _(t):
    return views.active_badges(t, AS_OF_TODAY)


@query("v04_end_to_end_latency", "SELECT * FROM v_end_to_end_latency")
def _(t):
    return views.end_to_end_latency(t, AS_OF)


@query("v05_data_freshness", "SELECT * FROM v_data_freshness")
def _(t):
    return views.data_freshness(t, AS_OF)


@query("v06_data_quality_metrics", "SELECT * FROM v_data_quality_metrics")
def _(t):
    return views.data_quality_metrics(t, AS_OF)


@query("v07_partition_efficiency", "SELECT * FROM v_partition_efficiency")
def _(t):
    return views.partition_efficiency(t, AS_OF_PRUNE)


@query("v08_streaming_costs", "SELECT * FROM v_streaming_costs")
def _(t):
    return views.streaming_costs(t, AS_OF)


@query("v09_task_execution_history",
       "SELECT * EXCLUDE (rows_processed, run_id) FROM task_runs")
def _(t):
    return views.task_execution_history(t, AS_OF_TASKS)


@query("v10_streaming_client_metrics", "SELECT * FROM v_streaming_client_metrics")
def _(t):
    return views.streaming_client_metrics(t, AS_OF)


@query("k01_overview", f"""
SELECT (SELECT max(total_rows_inserted) FROM v_channel_status) AS events_last_hour,
  (SELECT max(total_credits_used) FROM v_channel_status) AS credits_last_hour,
  (SELECT cast(sum(total_rows) AS bigint) FROM v_data_freshness) AS total_rows_stored,
  health_status AS raw_status, {x.humanize("seconds_since_update")} AS raw_age
FROM v_end_to_end_latency WHERE layer = 'RAW'""")
def _(t):
    return kpis.overview(t, AS_OF)


@query("k02_layer_cards", f"""
SELECT layer, health_status, {x.color("health_status")} AS color,
  {x.humanize("seconds_since_update")} AS last_update_age, row_count
FROM v_end_to_end_latency""")
def _(t):
    return kpis.layer_cards(t, AS_OF)


@query("k03_freshness_table", f"""
SELECT table_name, last_event_timestamp, {x.humanize("event_age_seconds")} AS event_age,
  {x.humanize("ingestion_age_seconds")} AS ingestion_age, total_rows, rows_last_hour
FROM v_data_freshness""")
def _(t):
    return kpis.freshness_table(t, AS_OF)


NEWEST_HOURS = "(SELECT * FROM v_ingestion_metrics ORDER BY ingestion_hour DESC LIMIT 24)"


@query("k04_ingestion_totals", f"""
SELECT {x.total("event_count")} AS total_events, avg(event_count) AS avg_events_per_hour,
  max(unique_badges) AS unique_badges,
  {x.half_up("sum(cast(round(avg_signal_strength * 100) AS bigint))", "100 * count(*)", 6)}
    AS avg_signal_strength
FROM {NEWEST_HOURS}""")
def _(t):
    return kpis.ingestion_totals(t, AS_OF)


@query("k05_entry_exit_series", f"""
SELECT ingestion_hour, 'Entry' AS direction, entry_count AS event_count FROM {NEWEST_HOURS}
UNION ALL SELECT ingestion_hour, 'Exit', exit_count FROM {NEWEST_HOURS}""")
def _(t):
    return kpis.entry_exit_series(t, AS_OF)


@query("k06_volume_series",
       f"SELECT ingestion_hour, event_count, weak_signal_pct FROM {NEWEST_HOURS}")
def _(t):
    return kpis.volume_series(t, AS_OF)


@query("k07_cost_totals", """
SELECT cast(sum(actual_credits_used) AS decimal(38,6)) AS total_credits,
  sum(gb_ingested) AS total_gb, cast(sum(rows_ingested) AS bigint) AS total_rows,
  CASE WHEN sum(gb_ingested) > 0
    THEN cast(sum(actual_credits_used) AS double) / sum(gb_ingested) ELSE 0 END
    AS avg_credits_per_gb
FROM (SELECT * FROM v_streaming_costs ORDER BY ingestion_date DESC LIMIT 30)""")
def _(t):
    return kpis.cost_totals(t, AS_OF)


SUCCESS_RATE = (
    "cast(100 AS double) * count(*) FILTER (execution_status = 'SUCCESS') / count(*)"
)


@query("k08_task_totals", f"""
SELECT count(*) AS total_executions, {SUCCESS_RATE} AS success_rate,
  avg(duration_seconds) AS avg_duration,
  count(*) FILTER (execution_status = 'FAILED') AS failed_count FROM newest_runs""")
def _(t):
    return kpis.task_totals(t, AS_OF_TASKS)


@query("k09_task_success", f"""
SELECT task_name, {SUCCESS_RATE} AS success_rate, avg(duration_seconds) AS avg_duration
FROM newest_runs GROUP BY task_name""")
def _(t):
    return kpis.task_success(t, AS_OF_TASKS)


@query("k10_status_distribution",
       "SELECT execution_status, count(*) AS runs FROM newest_runs GROUP BY 1")
def _(t):
    return kpis.status_distribution(t, AS_OF_TASKS)


@query("k11_recent_executions", """
SELECT task_name, scheduled_time, duration_seconds, execution_status, error_message
FROM (SELECT * FROM newest_runs ORDER BY execution_status, scheduled_time DESC, task_name,
  state, completed_time, duration_seconds, error_code, error_message, run_id LIMIT 20)""")
def _(t):
    return kpis.recent_executions(t, AS_OF_TASKS)


@query("k12_pruning_totals", f"""
SELECT {x.total("query_count")} AS total_queries,
  {x.half_up("sum(cast(round(avg_scan_ratio_pct * 100) AS bigint))", "100 * count(*)", 6)}
    AS avg_scan_ratio,
  {x.half_up("sum(cast(round(total_gb_scanned_approx * 100) AS bigint))", "100", 2)}
    AS total_gb_scanned,
  {x.half_up("sum(cast(round(row_prune_ratio_pct * 100) AS bigint))", "100 * count(*)", 6)}
    AS avg_prune_ratio
FROM v_partition_efficiency""")
def _(t):
    return kpis.pruning_totals(t, AS_OF_PRUNE)


CLIENT_DAYS = (
    "(SELECT * FROM v_streaming_client_metrics "
    "ORDER BY ingestion_date DESC, client_name LIMIT 30)"
)


@query("k13_client_totals", f"""
SELECT cast(sum(total_client_credits) AS decimal(38,6)) AS total_client_credits,
  sum(total_gb_sent) AS total_gb_sent, {x.total("total_rows_sent")} AS total_rows_sent,
  {x.total("session_count")} AS total_sessions FROM {CLIENT_DAYS}""")
def _(t):
    return kpis.client_totals(t, AS_OF)


@query("k14_client_series", f"""
SELECT client_name, ingestion_date, total_client_credits, total_rows_sent,
  avg_session_duration_seconds, session_count FROM {CLIENT_DAYS}""")
def _(t):
    return kpis.client_series(t, AS_OF)
