"""Operational queries (Q), alert rules (A) and described extensions (X)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from gatelog.catalog import expected as x
from gatelog.catalog.feeds import (
    AS_OF,
    AS_OF_PRUNE,
    AS_OF_TASKS,
    LOAD_TIME,
    SEED_TIME,
    truncated,
)
from gatelog.catalog.incremental import SPAN_FACTS, run_spans
from gatelog.catalog.registry import query
from gatelog.functions.times import ntz
from gatelog.operators import dims, facts, selection, sequences
from gatelog.plans import alerts, reports, views

HOUR_OF_TASKS = f"{x.AS_OF_TASKS} - INTERVAL '1' HOUR"
RUN_SECONDS = "date_diff('second', scheduled_time, completed_time)"


class With:
    """The feeds with some tables replaced."""

    def __init__(self, t, **tables):
        self._feeds = t
        self.__dict__.update(tables)

    def __getattr__(self, name):
        return getattr(self._feeds, name)


# --- Q: operational queries -------------------------------------------------------------


@query("q01_latest_raw_events", """
SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength,
  signal_quality, direction, ingestion_time FROM raw_events
ORDER BY ingestion_time DESC, badge_id, user_id, zone_id, reader_id, event_timestamp,
  signal_strength, signal_quality, direction LIMIT 10""")
def _(t):
    return reports.latest_raw_events(t)


@query("q01_newest_days", """
SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength,
  signal_quality, direction, ingestion_time FROM raw_events
ORDER BY ingestion_time DESC, badge_id, user_id, zone_id, reader_id, event_timestamp,
  signal_strength, signal_quality, direction LIMIT 10""")
def _(t):
    """From the daily folders of a warehouse that landed every event in batches."""
    return reports.latest_raw_events(run_spans(t, "newest-raw"))


@query("q04_newest_days", f"""
SELECT f.badge_id, f.user_id, u.user_name, f.zone_id, z.zone_name, f.event_timestamp,
  f.direction, f.signal_strength
FROM {SPAN_FACTS} f LEFT JOIN dim_users u ON f.user_id = u.user_id
LEFT JOIN dim_zones z ON f.zone_id = z.zone_id
ORDER BY f.event_timestamp DESC, f.badge_id LIMIT 10""")
def _(t):
    return reports.fact_details(run_spans(t, "newest-facts")).select(
        "badge_id", "user_id", "user_name", "zone_id", "zone_name", "event_timestamp",
        "direction", "signal_strength")


@query("q02_latest_task_runs", f"""
SELECT name, state, scheduled_time, completed_time, {RUN_SECONDS} AS duration_sec
FROM task_history WHERE name = 'raw_to_staging_task' AND scheduled_time >= {HOUR_OF_TASKS}
ORDER BY scheduled_time DESC, name, state, completed_time LIMIT 5""")
def _(t):
    return reports.latest_task_runs(t, "raw_to_staging_task", AS_OF_TASKS)


@query("q03_latest_staged", """
SELECT badge_id, user_id, zone_id, event_timestamp, staging_time FROM stg_events
ORDER BY staging_time DESC, badge_id, user_id, zone_id, event_timestamp LIMIT 10""")
def _(t):
    return reports.latest_staged(t)


@query("q04_fact_details", """
SELECT f.badge_id, f.user_id, u.user_name, u.department, f.zone_id, z.zone_name, z.zone_type,
  f.event_timestamp, f.direction, f.signal_strength
FROM fct_events f LEFT JOIN dim_users u ON f.user_id = u.user_id
LEFT JOIN dim_zones z ON f.zone_id = z.zone_id
ORDER BY f.event_timestamp DESC, f.badge_id LIMIT 10""")
def _(t):
    return reports.fact_details(t)


@query("q05_orphan_events", """
SELECT badge_id, user_id, zone_id FROM raw_events
WHERE user_id NOT IN (SELECT user_id FROM seed_users WHERE is_current)
  OR zone_id NOT IN (SELECT zone_id FROM dim_zones)""")
def _(t):
    return dims.orphan_events(t.raw, t.seeded_users, t.zones)


@query("q06_orphan_users", """
SELECT DISTINCT user_id FROM raw_events
WHERE user_id NOT IN (SELECT user_id FROM seed_users WHERE is_current)""")
def _(t):
    return dims.orphan_ids(t.raw, dims.current(t.seeded_users), "user_id")


LOADS = """SELECT file_name, last_load_time,
  CASE WHEN error_count = 0 THEN 'LOADED' WHEN error_count < row_count
    THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
  row_count, error_count, first_error_message
FROM load_log WHERE table_name = 'RAW_BADGE_EVENTS' AND last_load_time >= """


@query("q07_load_history", LOADS + x.HOUR_AGO)
def _(t):
    return reports.load_history(t.load_log, AS_OF)


@query("q08_failed_runs", """
SELECT name, state, scheduled_time, completed_time, error_code, error_message, run_id
FROM task_history WHERE state = 'FAILED'
  AND name IN ('raw_to_staging_task', 'staging_to_analytics_task')
ORDER BY scheduled_time DESC, name, state, completed_time, error_code, error_message, run_id
LIMIT 10""")
def _(t):
    return reports.failed_runs(t)


METERED = "SELECT * FROM metering_history WHERE warehouse_name = 'COMPUTE_WH' AND start_time >= "


@query("q09_compute_credits", METERED + f"{x.AS_OF_TASKS} - INTERVAL '7' DAY")
def _(t):
    return reports.compute_credits(t.metering, AS_OF_TASKS)


@query("q09_compute_credits_last_hour", METERED + HOUR_OF_TASKS)
def _(t):
    return reports.compute_credits(t.metering, AS_OF_TASKS, views.HOUR)


@query("q10_run_duration_trend", f"""
SELECT name, avg({RUN_SECONDS}) AS avg_duration_sec, max({RUN_SECONDS}) AS max_duration_sec,
  count(*) AS execution_count
FROM task_history WHERE scheduled_time >= {HOUR_OF_TASKS}
  AND name IN ('raw_to_staging_task', 'staging_to_analytics_task') GROUP BY name""")
def _(t):
    return reports.run_duration_trend(t, AS_OF_TASKS)


@query("q11_failures_by_message", """
SELECT task_name, error_message, count(*) AS failure_count FROM task_runs
WHERE state = 'FAILED' GROUP BY 1, 2""")
def _(t):
    return reports.failures_by_message(t, AS_OF_TASKS)


IDLE = f"""SELECT date_trunc('day', start_time) AS day,
  cast(sum(credits_used) AS decimal(19,2)) AS total_credits,
  cast(sum(CASE WHEN credits_used_compute = 0 THEN credits_used ELSE 0 END)
    AS decimal(19,2)) AS idle_credits,
  cast(sum(CASE WHEN credits_used_compute = 0 THEN credits_used ELSE 0 END) AS double)
    / nullif(cast(sum(credits_used) AS double), 0) * 100 AS idle_percent
FROM metering_history WHERE warehouse_name = 'COMPUTE_WH'
  AND start_time >= {x.AS_OF_TASKS} - INTERVAL '30' DAY
GROUP BY date_trunc('day', start_time)"""


@query("q12_idle_credits", IDLE)
def _(t):
    return reports.idle_credits(t.metering, AS_OF_TASKS)


@query("q13_storage_by_schema", f"""
SELECT table_catalog AS database_name, table_schema AS schema_name,
  {x.gib("active_bytes")} AS active_storage_gb,
  {x.gib("time_travel_bytes")} AS time_travel_storage_gb,
  {x.gib("failsafe_bytes")} AS failsafe_storage_gb,
  {x.gib("active_bytes + time_travel_bytes + failsafe_bytes")} AS total_storage_gb
FROM storage_metrics WHERE table_catalog = 'DEMO' AND active_bytes > 0 GROUP BY 1, 2""")
def _(t):
    return reports.storage_by_schema(t.storage)


SLOWEST = f"""SELECT query_id, query_text, execution_status,
  total_elapsed_ms / cast(1000 AS double) AS execution_time_sec,
  bytes_scanned / pow(1024, 3) AS gb_scanned, partitions_scanned, partitions_total
FROM query_history WHERE execution_status = 'SUCCESS' AND database_name = 'DEMO'
  AND start_time >= {x.AS_OF_PRUNE} - INTERVAL '{{days}}' DAY
ORDER BY total_elapsed_ms DESC, query_id, query_text, gb_scanned, partitions_scanned,
  partitions_total LIMIT 10"""
MONTH_BEFORE = AS_OF_PRUNE - 30 * views.DAY  # the last month of shipments


@query("q14_slowest_queries", SLOWEST.format(days=31))
def _(t):
    return reports.slowest_queries(t.queries, MONTH_BEFORE)


@query("q15_last_hour_summary", f"""
SELECT 'Last Hour Summary' AS metric_group, count(*) AS raw_events,
  count(DISTINCT badge_id) AS unique_badges, count(DISTINCT user_id) AS unique_users,
  cast({x.half_up("sum(cast(signal_strength AS bigint))", "count(*)", 6)} AS decimal(9,6))
    AS avg_signal_strength
FROM raw_events WHERE ingestion_time >= {x.HOUR_AGO}""")
def _(t):
    return reports.last_hour_summary(t, AS_OF)


@query("q16_ingestion_rate", f"""
SELECT 'Ingestion Rate (Last 10 Min)' AS metric_group, count(*) AS events,
  {x.half_up("count(*)", "10", 6)} AS events_per_minute
FROM raw_events WHERE ingestion_time >= {x.AS_OF} - INTERVAL '10' MINUTE""")
def _(t):
    return reports.ingestion_rate(t, AS_OF)


@query("q17_task_health", f"""
SELECT 'Task Health' AS metric_group, task_name, state, duration_seconds, rows_processed
FROM (SELECT * FROM task_runs WHERE scheduled_time >= {HOUR_OF_TASKS}
  ORDER BY scheduled_time DESC, task_name, state, completed_time, duration_seconds,
    error_code, error_message, execution_status, rows_processed LIMIT 5)""")
def _(t):
    return reports.task_health(t, AS_OF_TASKS)


@query("q18_badges_active_now", f"""
SELECT 'Active Badges (Last 5 Min)' AS metric_group, count(DISTINCT badge_id) AS active_badges
FROM raw_events WHERE ingestion_time >= {x.AS_OF} - INTERVAL '5' MINUTE""")
def _(t):
    return reports.badges_active_now(t, AS_OF)


@query("q19_busiest_badges", f"""
SELECT badge_id, count(*) AS event_count FROM raw_events WHERE ingestion_time >= {x.HOUR_AGO}
GROUP BY badge_id ORDER BY event_count DESC, badge_id LIMIT 10""")
def _(t):
    return reports.busiest_badges(t, AS_OF)


ONE_BADGE = """SELECT badge_id, user_id, zone_id, event_timestamp, signal_strength,
  signal_quality, ingestion_time FROM raw_events WHERE badge_id = 'BADGE-000013'
ORDER BY ingestion_time DESC, user_id, zone_id, event_timestamp, signal_strength LIMIT 10"""


@query("q20_events_for_badge", ONE_BADGE)
def _(t):
    return selection.events_for_badge(t.raw, "BADGE-000013")


@query("q21_payload_span", """
SELECT count(*) AS total_events, min(event_timestamp) AS first_event,
  max(event_timestamp) AS last_event FROM badge_feed""")
def _(t):
    payloads = t.json_lines().select(F.col("value").alias("raw_json"))
    return reports.payload_span(payloads)


@query("q22_staged_count", "SELECT count(*) AS processed_events FROM stg_events")
def _(t):
    return reports.staged_count(t)


@query("q23_credits_30_days", """
SELECT cast(sum(actual_credits_used) AS decimal(38,6)) AS total_credits_last_30_days
FROM v_streaming_costs""")
def _(t):
    return reports.credits_30_days(t, AS_OF)


@query("q23_successful_runs", """
SELECT task_name, count(*) AS executions, avg(duration_seconds) AS avg_duration
FROM task_runs WHERE execution_status = 'SUCCESS' GROUP BY task_name""")
def _(t):
    return reports.successful_runs(t, AS_OF_TASKS)


@query("q23_client_usage", f"""
SELECT client_name, cast(sum(total_client_credits) AS decimal(38,6)) AS credits,
  {x.total("total_rows_sent")} AS rows FROM v_streaming_client_metrics GROUP BY client_name""")
def _(t):
    return reports.client_usage(t, AS_OF)


@query("q24_access_audit", f"""
SELECT user_name, client_ip, event_type, start_time, query_text FROM query_history
WHERE user_name = 'user-3' AND start_time >= {x.AS_OF_PRUNE} - INTERVAL '31' DAY""")
def _(t):
    return reports.access_audit(t.queries, "user-3", AS_OF_PRUNE - timedelta(days=30))


@query("q25_user_listing", """
SELECT user_id, user_name, user_type, department, clearance_level, is_active, is_current
FROM dim_users""")
def _(t):
    return reports.user_listing(t)


@query("q25_zone_listing", """
SELECT zone_id, building_name, cast(floor_number AS integer) AS floor_number, zone_name,
  zone_type, requires_clearance, is_restricted, is_monitored, events
FROM dim_zones JOIN (SELECT zone_id, count(*) AS events FROM raw_events GROUP BY 1)
  USING (zone_id)""")
def _(t):
    events = t.raw.groupBy("zone_id").agg(F.count("*").alias("events"))
    return reports.zone_listing(t).join(events, "zone_id")


@query("q26_duplicate_keys", """
SELECT badge_id, event_timestamp, count(*) AS copies FROM stg_events
GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return selection.duplicate_keys(t.stg)


@query("q27_runs_by_prefix", """
SELECT name, state, scheduled_time, completed_time FROM task_history WHERE name LIKE 'raw_%'
ORDER BY scheduled_time DESC, name, state, completed_time LIMIT 10""")
def _(t):
    return reports.runs_by_prefix(t, "raw_")


# --- A: alert rules ---------------------------------------------------------------------

ALL_RUNS = timedelta(days=4000)
RUNS = "SELECT * EXCLUDE (rows_processed, run_id) FROM every_run WHERE "


@query("a01_failed_runs", RUNS + "state = 'FAILED'")
def _(t):
    return alerts.failed_runs(t, AS_OF_TASKS, ALL_RUNS)


# Six hours after the last event, so that the day looked at ends in a gap.
STOPPED = f"{x.AS_OF} + INTERVAL '6' HOUR"


@query("a02_ingestion_stopped", f"""
SELECT min(h) AS first_hour, max(h) AS last_hour, count(*) AS idle_hours
FROM (SELECT h, n, sum(CASE WHEN n IS NULL THEN 0 ELSE 1 END) OVER (ORDER BY h) AS grp
  FROM (SELECT unnest(generate_series(date_trunc('hour', {STOPPED} - INTERVAL '1' DAY),
      date_trunc('hour', {STOPPED}), INTERVAL '1' HOUR)) AS h) s
  LEFT JOIN (SELECT date_trunc('hour', ingestion_time) AS ih, count(*) AS n FROM raw_events
    WHERE ingestion_time >= {STOPPED} - INTERVAL '1' DAY GROUP BY 1) e
    ON s.h = e.ih) WHERE n IS NULL GROUP BY grp HAVING count(*) > 2""")
def _(t):
    return alerts.ingestion_stopped(t, AS_OF + timedelta(hours=6))


@query("a03_volume_drop", """
SELECT * FROM (SELECT *, 100 * (cast(event_count AS double) - previous_event_count)
    / nullif(previous_event_count, 0) AS change_pct
  FROM (SELECT ingestion_hour, event_count,
      lag(event_count) OVER (ORDER BY ingestion_hour) AS previous_event_count
    FROM v_ingestion_metrics)) WHERE change_pct < -20""")
def _(t):
    return alerts.volume_drop(t, AS_OF, threshold=20)


def _quality(rule: str, limit: float) -> str:
    return (
        f"SELECT '{rule}' AS rule, {rule} AS value, cast({limit} AS double) AS threshold "
        f"FROM v_data_quality_metrics WHERE {rule} > {limit}"
    )


@query("a04_high_orphan_rate", _quality("orphan_rate_pct", 4))
def _(t):
    return alerts.high_orphan_rate(t, AS_OF, threshold=4)


LATENCY = """SELECT CASE WHEN s < 60 THEN '0-60s' WHEN s < 120 THEN '60-120s'
    WHEN s < 180 THEN '120-180s' WHEN s < 300 THEN '180-300s' ELSE '300s+' END AS lag_bucket,
  count(*) AS event_count, avg(s) AS avg_latency_seconds, max(s) AS max_latency_seconds,
  round(quantile_cont(cast(s AS double), 0.95), 6) AS p95_latency_seconds
FROM (SELECT date_diff('second', event_timestamp, fact_load_time) AS s FROM fct_events
  WHERE fact_load_time >= {month_ago})
GROUP BY 1""".format(month_ago=x.MONTH_AGO)


@query("a05_high_latency", f"""
SELECT * FROM ({LATENCY}) WHERE avg_latency_seconds > 180 OR max_latency_seconds > 300""")
def _(t):
    return alerts.high_latency(t.facts, AS_OF, span=30 * views.DAY)


@query("a06_high_duplicate_rate", _quality("duplicate_rate_pct", 1))
def _(t):
    return alerts.high_duplicate_rate(t, AS_OF, threshold=1)


VARIED_CREDITS = """(SELECT cast(end_time AS date) AS ingestion_date,
  cast(sum(num_rows_migrated) AS bigint) AS rows_ingested,
  cast(sum(credits_used * (1 + day(end_time) % 3)) AS decimal(38,6)) AS actual_credits_used
  FROM migration_history GROUP BY 1)"""


def _varied_credits(t):
    factor = (1 + F.dayofmonth("end_time") % 3).cast("decimal(10,0)")
    return With(t, migration=t.migration.withColumn(
        "credits_used", (F.col("credits_used") * factor).cast("decimal(28,6)")))


@query("a07_cost_spike", f"""
SELECT * FROM (SELECT *, 100 * (cast(actual_credits_used AS double)
    - cast(previous_actual_credits_used AS double))
    / nullif(cast(previous_actual_credits_used AS double), 0) AS change_pct
  FROM (SELECT ingestion_date, actual_credits_used,
      lag(actual_credits_used) OVER (ORDER BY ingestion_date) AS previous_actual_credits_used
    FROM {VARIED_CREDITS} WHERE ingestion_date >= DATE '2024-01-01')) WHERE change_pct > 50""")
def _(t):
    return alerts.cost_spike(_varied_credits(t), AS_OF)


@query("a08_high_weak_signal_rate", _quality("weak_signal_rate_pct", 5))
def _(t):
    return alerts.high_weak_signal_rate(t, AS_OF, threshold=5)


@query("a09_slow_runs", RUNS + "duration_seconds > 30")
def _(t):
    return alerts.slow_runs(t, AS_OF_TASKS, span=ALL_RUNS)


@query("a10_idle_runs", """
SELECT task_name, min(scheduled_time) AS first_run, max(scheduled_time) AS last_run,
  count(*) AS idle_runs
FROM (SELECT *, sum(CASE WHEN rows_processed = 0 THEN 0 ELSE 1 END) OVER (
    PARTITION BY task_name ORDER BY scheduled_time, run_id, completed_time
    ROWS UNBOUNDED PRECEDING) AS grp
  FROM every_run)
WHERE rows_processed = 0 GROUP BY task_name, grp HAVING count(*) > 2""")
def _(t):
    return alerts.idle_runs(t, AS_OF_TASKS, count=2, span=ALL_RUNS)


@query("a11_rising_unit_cost", f"""
SELECT * FROM (SELECT *,
    lag(rows_ingested) OVER (ORDER BY ingestion_date) AS previous_rows_ingested,
    lag(actual_credits_used) OVER (ORDER BY ingestion_date) AS previous_actual_credits_used
  FROM {VARIED_CREDITS} WHERE ingestion_date >= DATE '2024-01-01')
WHERE actual_credits_used * previous_rows_ingested
  > previous_actual_credits_used * rows_ingested""")
def _(t):
    return alerts.rising_unit_cost(_varied_credits(t), AS_OF)


CHANNELS = f"""SELECT name AS channel_name,
  CASE WHEN arg_max(state, {{order}}) = 'FAILED' THEN 'ERROR'
    WHEN date_diff('second', max(completed_time), {{as_of}}) > 86400 THEN 'CLOSED'
    ELSE 'OPEN' END AS status,
  max(completed_time) AS last_poll_time, {x.total("rows_processed")} AS rows_ingested,
  {x.total("rows_processed * 500")} AS bytes_ingested,
  count(*) FILTER (state = 'FAILED') AS error_count
FROM task_history GROUP BY name""".format(
    order="row(scheduled_time, completed_time, state)", as_of=x.AS_OF_TASKS
)


def _batch_log(t):
    return t.tasks.withColumn("bytes_processed", F.col("rows_processed") * 500)


@query("a12_unhealthy_channels", f"""
SELECT * FROM ({CHANNELS}) WHERE status = 'ERROR' OR (status = 'OPEN'
  AND date_diff('second', last_poll_time, {x.AS_OF_TASKS}) > 300)""")
def _(t):
    return alerts.unhealthy_channels(_batch_log(t), AS_OF_TASKS)


@query("a13_storage_growth", f"""
SELECT day, storage_pct, event_pct FROM (SELECT day,
    100 * (cast(b AS double) - lag(b) OVER (ORDER BY day))
      / nullif(lag(b) OVER (ORDER BY day), 0) AS storage_pct,
    100 * (cast(n AS double) - lag(n) OVER (ORDER BY day))
      / nullif(lag(n) OVER (ORDER BY day), 0) AS event_pct
  FROM (SELECT date_trunc('day', ingestion_time)::timestamp AS day, count(*) AS n,
      cast(sum((length(raw_json) + 500) * (1 + day(ingestion_time) % 3)) AS bigint) AS b
    FROM raw_events WHERE ingestion_time >= date_trunc('day', {x.MONTH_AGO})
    GROUP BY 1)) WHERE storage_pct > 10 AND event_pct <= 10""")
def _(t):
    size = (F.length("raw_json") + 500) * (1 + F.dayofmonth("ingestion_time") % 3)
    days = t.raw.groupBy(truncated("day", "ingestion_time").alias("day")).agg(
        F.sum(size).alias("total_bytes"))
    return alerts.storage_growth(days, t.raw, AS_OF)


@query("a14_missed_targets", f"""
SELECT 'idle_percent' AS target, cast(cast(day AS date) AS varchar) AS subject,
  idle_percent AS value FROM ({IDLE}) WHERE idle_percent >= 10
UNION ALL SELECT 'scan_share', cast(query_id AS varchar),
  cast(partitions_scanned AS double) / nullif(partitions_total, 0)
  FROM ({SLOWEST.format(days=31)})
  WHERE cast(partitions_scanned AS double) / nullif(partitions_total, 0) >= cast(0.1 AS double)
UNION ALL SELECT 'seconds', cast(query_id AS varchar), execution_time_sec
  FROM ({SLOWEST.format(days=31)}) WHERE execution_time_sec >= 5""")
def _(t):
    return alerts.missed_targets(t.metering, t.queries, AS_OF_TASKS, MONTH_BEFORE)


@query("a15_quality_violations", " UNION ALL ".join([
    _quality("orphan_rate_pct", 4), _quality("duplicate_rate_pct", 1),
    _quality("weak_signal_rate_pct", 5)]))
def _(t):
    return alerts.quality_violations(t, AS_OF, orphans=4, duplicates=1, weak=5)


# --- X: described extensions ------------------------------------------------------------


@query("x01_drop_faint_signals", """
SELECT seq, signal_strength FROM raw_events
WHERE signal_strength >= -85 OR signal_strength = -999""")
def _(t):
    return facts.drop_faint(t.raw, floor=-85).select("seq", "signal_strength")


@query("x02_dwell_times", """
SELECT badge_id, zone_id, event_timestamp AS entry_timestamp, next_ts AS exit_timestamp,
  date_diff('microsecond', event_timestamp, next_ts) / cast(60000000 AS double)
    AS dwell_time_minutes
FROM (SELECT *, lead(event_timestamp) OVER w AS next_ts, lead(direction) OVER w AS next_dir
  FROM fct_events WINDOW w AS (PARTITION BY badge_id, zone_id ORDER BY event_timestamp))
WHERE direction = 'ENTRY' AND next_dir = 'EXIT'""")
def _(t):
    return sequences.dwell_times(t.facts)


@query("x03_scd2_apply", f"""
WITH updates AS (SELECT user_id, max(zone_id) AS department FROM raw_events
  GROUP BY 1),
merged AS (SELECT s.user_id, s.user_name, s.user_type, s.clearance_level,
    s.department AS old_department, u.department AS new_department,
    u.user_id IS NOT NULL AS touched FROM seed_users s LEFT JOIN updates u USING (user_id))
SELECT user_id, user_name, old_department AS department, NOT touched AS is_current,
  CASE WHEN touched THEN {x.stamp(LOAD_TIME)} END AS effective_end_date,
  {x.stamp(SEED_TIME)} AS effective_start_date FROM merged
UNION ALL SELECT user_id, user_name, new_department, TRUE, NULL, {x.stamp(LOAD_TIME)}
  FROM merged WHERE touched
UNION ALL SELECT user_id, 'UNKNOWN', department, TRUE, NULL, {x.stamp(LOAD_TIME)}
  FROM updates WHERE user_id NOT IN (SELECT user_id FROM seed_users)""")
def _(t):
    latest = t.raw.groupBy("user_id").agg(
        F.max("zone_id").alias("department"))
    known = t.seeded_users.select("user_id", "user_name", "user_type", "clearance_level")
    unknown = {c: "UNKNOWN" for c in ("user_name", "user_type")} | {"clearance_level": "PUBLIC"}
    updates = latest.join(known, "user_id", "left").fillna(unknown)
    merged = dims.scd2_apply(t.seeded_users, updates, LOAD_TIME, start=6)
    return merged.select(
        "user_id", "user_name", "department", "is_current", "effective_end_date",
        "effective_start_date")


@query("x04_facts_left_join", """
SELECT s.seq, s.user_id, s.zone_id, u.user_id IS NOT NULL AS user_known,
  z.zone_id IS NOT NULL AS zone_known, z.is_restricted AS is_restricted_access
FROM stg_events s LEFT JOIN seed_users u ON s.user_id = u.user_id AND u.is_current
LEFT JOIN dim_zones z ON s.zone_id = z.zone_id""")
def _(t):
    enriched = facts.enrich(t.stg, t.seeded_users, t.zones, how="left")
    return enriched.select(
        "seq", "user_id", "zone_id",
        F.col("user_key").isNotNull().alias("user_known"),
        F.col("zone_key").isNotNull().alias("zone_known"), "is_restricted_access")


@query("x05_table_wide_dedupe", """
SELECT seq, badge_id, event_timestamp FROM (SELECT * FROM raw_events
  WHERE cast(ingestion_time AS date) >= DATE '2024-01-16' QUALIFY row_number() OVER (
    PARTITION BY badge_id, event_timestamp ORDER BY ingestion_time DESC, seq DESC) = 1) b
WHERE NOT EXISTS (SELECT 1 FROM stg_events o WHERE o.batch_date < DATE '2024-01-16'
  AND o.badge_id = b.badge_id AND o.event_timestamp = b.event_timestamp)
UNION ALL SELECT seq, badge_id, event_timestamp FROM stg_events
WHERE batch_date < DATE '2024-01-16'""")
def _(t):
    earlier = t.stg.filter("batch_date < DATE '2024-01-16'")
    batch = facts.stage_batch(t.raw.filter(F.to_date("ingestion_time") >= "2024-01-16"))
    merged = earlier.unionByName(facts.unstaged(batch, earlier), allowMissingColumns=True)
    return merged.select("seq", "badge_id", "event_timestamp")


@query("x06_latency_distribution", LATENCY)
def _(t):
    return reports.latency_distribution(t.facts, AS_OF, 30 * views.DAY)


@query("x07_extended_hourly_metrics", f"""
SELECT v.*, e.unique_users, {x.half_up("event_count", "60", 6)} AS avg_events_per_minute
FROM v_ingestion_metrics v JOIN (SELECT date_trunc('hour', ingestion_time) AS h,
    count(DISTINCT user_id) AS unique_users FROM raw_events
  WHERE ingestion_time >= {x.DAY_AGO} GROUP BY 1) e ON v.ingestion_hour = e.h""")
def _(t):
    return views.ingestion_metrics(t, AS_OF, extended=True)


@query("x08_channel_table", CHANNELS)
def _(t):
    return reports.channel_table(_batch_log(t), AS_OF_TASKS)


@query("x09_rows_processed", "SELECT * EXCLUDE (run_id) FROM task_runs")
def _(t):
    return views.task_execution_history(t, AS_OF_TASKS, extra=("rows_processed",))


@query("x10_cost_estimate", f"""
SELECT day, ingest_credits, seconds / cast(3600 AS double) AS compute_credits,
  ingest_credits + seconds / cast(3600 AS double) AS total_credits
FROM (SELECT day, max(c) AS ingest_credits, cast(sum(s) AS bigint) AS seconds
  FROM (SELECT ingestion_date AS day, gb_ingested * cast(0.06 AS double) AS c,
      cast(0 AS bigint) AS s FROM v_streaming_costs
    UNION ALL SELECT cast({x.AS_OF} - (run_id % 43200) * INTERVAL '1' MINUTE AS date), 0,
      date_diff('second', scheduled_time, completed_time) FROM task_history)
  GROUP BY day)""")
def _(t):
    minutes = F.make_dt_interval(mins=(F.col("run_id") % 43200).cast("int"))
    gap = F.col("completed_time") - F.col("scheduled_time")
    recent = t.tasks.withColumns(
        {"scheduled_time": ntz(AS_OF) - minutes, "completed_time": ntz(AS_OF) - minutes + gap})
    return reports.cost_estimate(With(t, tasks=recent), AS_OF)


@query("x11_reader_attributes", f"""
SELECT seq, reader_id, reader_name, firmware_version, is_online
FROM raw_events LEFT JOIN (SELECT reader_id, concat('Reader ', reader_id) AS reader_name,
    concat('1.', count(DISTINCT zone_id)) AS firmware_version,
    max(ingestion_time) >= {x.DAY_AGO} AS is_online
  FROM raw_events WHERE reader_id <> 'RDR-UNKNOWN' GROUP BY reader_id) r USING (reader_id)""")
def _(t):
    heard = F.max("ingestion_time") >= ntz(AS_OF - views.DAY)
    readers = t.raw.filter("reader_id <> 'RDR-UNKNOWN'").groupBy("reader_id").agg(
        F.concat(F.lit("Reader "), F.col("reader_id")).alias("reader_name"),
        F.concat(F.lit("1."), F.countDistinct("zone_id").cast("string"))
        .alias("firmware_version"),
        heard.alias("is_online"))
    return dims.with_reader(t.raw, readers).select(
        "seq", "reader_id", "reader_name", "firmware_version", "is_online")
