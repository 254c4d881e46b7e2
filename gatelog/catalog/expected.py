"""The derived tables and views once more, as plain SQL for an independent engine."""

from __future__ import annotations

import re

from gatelog.catalog import feeds
from gatelog.sources.seeds import USER_ROWS, ZONE_ROWS


def stamp(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


AS_OF = stamp(feeds.AS_OF)
AS_OF_TODAY = stamp(feeds.AS_OF_TODAY)
AS_OF_TASKS = stamp(feeds.AS_OF_TASKS)
AS_OF_PRUNE = stamp(feeds.AS_OF_PRUNE)
HOUR_AGO = f"{AS_OF} - INTERVAL '1' HOUR"
DAY_AGO = f"{AS_OF} - INTERVAL '1' DAY"
MONTH_AGO = f"{AS_OF} - INTERVAL '30' DAY"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator/denominator rounded half away from zero, on integers, as a double."""
    n, d = f"cast({numerator} as hugeint)", f"cast(nullif({denominator}, 0) as hugeint)"
    whole = f"(abs({n}) * {2 * 10**digits} + {d}) // (2 * {d})"
    return f"cast(sign({n}) * ({whole}) as double) / {10**digits}"


def pct(numerator: str, denominator: str) -> str:
    return half_up(f"100 * ({numerator})", denominator, 2)


def total(expression: str) -> str:
    return f"cast(sum({expression}) as bigint)"


def gib(expression: str) -> str:
    return f"{total(expression)} / pow(1024, 3)"


def credits(expression: str) -> str:
    return f"cast(sum({expression}) as decimal(28,6))"


def humanize(s: str) -> str:
    return (
        f"CASE WHEN {s} < 60 THEN concat({s}, 's') "
        f"WHEN {s} < 3600 THEN concat({s} // 60, 'm ', {s} % 60, 's') "
        f"WHEN {s} >= 3600 THEN concat({s} // 3600, 'h ', ({s} % 3600) // 60, 'm') END"
    )


def color(status: str) -> str:
    return (
        f"CASE {status} WHEN 'HEALTHY' THEN 'green' WHEN 'WARNING' THEN 'orange' "
        "WHEN 'STALE' THEN 'red' WHEN 'SUCCESS' THEN 'green' WHEN 'FAILED' THEN 'red' "
        "ELSE 'gray' END"
    )


def _value(v) -> str:
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else str(v).upper()


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_value, row)) + ")" for row in rows)


KNOWN_ZONES = ", ".join(_value(row[0]) for row in ZONE_ROWS)
_ZONE_CASE = "CASE event_id % 20 WHEN 19 THEN '{unknown}' ELSE CASE event_id % 5 {cases} END END"


def _zone_case(position: int, unknown: str) -> str:
    values = [row[position] for row in ZONE_ROWS]
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return _ZONE_CASE.format(unknown=unknown, cases=cases)


def _layer(layer: str, table: str, column: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, max({column}) AS last_update, count(*) AS row_count "
        f"FROM {table} WHERE {column} >= {HOUR_AGO}"
    )


def _fresh(table: str, source: str, loaded: str) -> str:
    return f"""SELECT '{table}' AS table_name, max(event_timestamp) AS last_event_timestamp,
      max({loaded}) AS last_ingestion_timestamp,
      date_diff('second', max(event_timestamp), {AS_OF}) AS event_age_seconds,
      date_diff('second', max({loaded}), {AS_OF}) AS ingestion_age_seconds,
      count(*) AS total_rows,
      {total(f"CASE WHEN {loaded} >= {HOUR_AGO} THEN 1 ELSE 0 END")} AS rows_last_hour
    FROM {source}"""


_SCAN_PCT = (
    "cast(100 as double) * sum(partitions_scanned) "
    "/ nullif(sum(partitions_scanned + partitions_pruned), 0)"
)

TABLES = {
    "badge_feed": f"""
SELECT event_id AS seq,
  concat('BADGE-', lpad(cast(1 + user_id AS varchar), 6, '0')) AS badge_id,
  concat('USR-', lpad(cast(1 + user_id % 8 AS varchar), 3, '0')) AS user_id,
  {_zone_case(0, "ZONE-UNKNOWN")} AS zone_id, {_zone_case(1, "RDR-UNKNOWN")} AS reader_id,
  cast(date_trunc('hour', ts) AS timestamp) AS event_timestamp,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE
    cast(cast(-30 AS decimal(9,2))
      - cast(cast(round(value * 100) AS bigint) % 6000 AS decimal(9,2))
        * cast(0.01 AS decimal(3,2)) AS decimal(9,2)) END AS signal_in,
  CASE WHEN event_type IN ('click', 'signup') THEN 'entry'
    WHEN event_type IN ('view', 'purchase') THEN 'exit' END AS direction_in,
  cast(ts + (event_id % 120) * INTERVAL '1' SECOND AS timestamp) AS ingestion_time,
  props AS extra_json
FROM events""",
    "raw_events": """
SELECT seq, badge_id, user_id, zone_id, reader_id, event_timestamp,
  cast(coalesce(cast(signal_in AS decimal(38,0)), -999) AS decimal(5,2)) AS signal_strength,
  CASE WHEN cast(signal_in AS decimal(38,0)) < -80 THEN 'WEAK'
    WHEN cast(signal_in AS decimal(38,0)) < -60 THEN 'MEDIUM' ELSE 'STRONG' END
    AS signal_quality,
  upper(direction_in) AS direction, ingestion_time, extra_json AS raw_json
FROM badge_feed""",
    "stg_events": """
SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength,
  signal_quality, direction, ingestion_time,
  cast(ingestion_time + INTERVAL '60' SECOND AS timestamp) AS staging_time,
  cast(ingestion_time AS date) AS batch_date, seq
FROM raw_events
QUALIFY row_number() OVER (PARTITION BY cast(ingestion_time AS date), badge_id,
  event_timestamp ORDER BY ingestion_time DESC, seq DESC) = 1""",
    "fct_events": f"""
SELECT user_id, zone_id, badge_id, reader_id, event_timestamp,
  cast(event_timestamp AS date) AS event_date, signal_strength, signal_quality, direction,
  ingestion_time, cast(ingestion_time + INTERVAL '120' SECOND AS timestamp) AS fact_load_time
FROM stg_events WHERE zone_id IN ({KNOWN_ZONES})
QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp ORDER BY batch_date) = 1""",
    "seed_users": f"""
SELECT *, TRUE AS is_active, TRUE AS is_current FROM (VALUES {_values(USER_ROWS)})
  AS v(user_id, user_name, user_type, department, clearance_level)""",
    "dim_users": """
SELECT * FROM seed_users UNION ALL
SELECT DISTINCT user_id, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'PUBLIC', TRUE, TRUE
FROM raw_events WHERE user_id NOT IN (SELECT user_id FROM seed_users)""",
    "dim_zones": f"""
SELECT *, TRUE AS is_monitored FROM (VALUES {_values(ZONE_ROWS)}) AS v(zone_id, reader_id,
  building_name, floor_number, zone_name, zone_type, capacity, requires_clearance,
  is_restricted, reader_location, reader_type)""",
    "migration_history": """
SELECT 'RAW_BADGE_EVENTS' AS table_name, max(ingestion_time) AS end_time,
  count(*) AS num_rows_migrated,
  cast(sum(length(raw_json) + 500) AS bigint) AS num_bytes_migrated,
  cast(count(*) * 0.000001 AS decimal(18,6)) AS credits_used
FROM raw_events GROUP BY date_trunc('hour', ingestion_time), seq % 4""",
    "client_history": """
SELECT concat('client-', cast(seq % 3 AS varchar)) AS client_name,
  min(ingestion_time) AS start_time, max(ingestion_time) AS end_time,
  cast(count(*) * 0.000001 AS decimal(18,6)) AS credits_used,
  cast(sum(length(raw_json) + 500) AS bigint) AS data_sent_bytes, count(*) AS rows_sent
FROM raw_events GROUP BY seq % 3, date_trunc('hour', ingestion_time)""",
    "task_history": """
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'raw_to_staging_task'
    ELSE 'staging_to_analytics_task' END AS name,
  'DEMO' AS database_name,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'FAILED' ELSE 'SKIPPED' END
    AS state,
  cast(o_orderdate AS timestamp) AS scheduled_time,
  cast(o_orderdate + (o_orderkey % 40) * INTERVAL '1' SECOND AS timestamp) AS completed_time,
  CASE WHEN o_orderstatus = 'O' THEN cast(1000 + o_orderkey % 3 AS varchar) END AS error_code,
  CASE WHEN o_orderstatus = 'O' THEN concat('error ', cast(o_orderkey % 3 AS varchar)) END
    AS error_message,
  o_orderkey % 5 AS rows_processed, o_orderkey AS run_id
FROM orders""",
    "pruning_history": """
SELECT CASE l_returnflag WHEN 'A' THEN 'RAW_BADGE_EVENTS' WHEN 'N' THEN 'FCT_ACCESS_EVENTS'
    ELSE 'OTHER' END AS table_name,
  cast(l_shipdate AS timestamp) AS interval_start_time,
  cast(l_linenumber AS bigint) AS num_queries, cast(l_quantity AS bigint) AS partitions_scanned,
  l_partkey % 200 AS partitions_pruned, cast(l_quantity AS bigint) * 100000 AS rows_scanned,
  (l_partkey % 200) * 100000 AS rows_pruned
FROM lineitem""",
    "metering_history": """
SELECT 'COMPUTE_WH' AS warehouse_name, cast(o_orderdate AS timestamp) AS start_time,
  cast(o_orderdate + INTERVAL '1' HOUR AS timestamp) AS end_time,
  cast(o_orderkey % 97 AS decimal(9,2)) AS credits_used,
  CASE WHEN o_orderkey % 7 = 0 THEN cast(0 AS decimal(9,2))
    ELSE cast(o_orderkey % 97 AS decimal(9,2)) END AS credits_used_compute
FROM orders""",
    "storage_metrics": """
SELECT 'DEMO' AS table_catalog, p_brand AS table_schema, p_name AS table_name,
  p_partkey * 1000000 AS active_bytes, (p_partkey % 50) * 1000000 AS time_travel_bytes,
  (p_partkey % 20) * 1000000 AS failsafe_bytes
FROM part""",
    "query_history": """
SELECT cast(l_orderkey * 10 + l_linenumber AS bigint) AS query_id,
  concat('user-', cast(l_suppkey % 10 AS varchar)) AS user_name, 'DEMO' AS database_name,
  CASE l_linestatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAIL' END AS execution_status,
  cast(l_shipdate AS timestamp) AS start_time,
  cast(floor(l_extendedprice) AS bigint) AS total_elapsed_ms,
  cast(l_quantity AS bigint) * 100000000 AS bytes_scanned,
  cast(l_quantity AS bigint) AS partitions_scanned,
  cast(l_quantity AS bigint) + l_partkey % 200 AS partitions_total,
  concat('select ', cast(l_partkey AS varchar)) AS query_text,
  concat('10.0.0.', cast(l_suppkey % 250 AS varchar)) AS client_ip, l_linestatus AS event_type
FROM lineitem""",
    "load_log": """
SELECT 'RAW_BADGE_EVENTS' AS table_name, strftime(max(ingestion_time), '%Y%m%d%H') AS file_name,
  max(ingestion_time) AS last_load_time, count(*) AS row_count,
  count(*) FILTER (zone_id = 'ZONE-UNKNOWN') AS error_count,
  min(badge_id) FILTER (zone_id = 'ZONE-UNKNOWN') AS first_error_message
FROM raw_events GROUP BY date_trunc('hour', ingestion_time)""",
    "v_channel_status": f"""
SELECT table_name AS pipe_name, max(end_time) AS last_ingestion_time,
  date_diff('second', max(end_time), {AS_OF}) AS seconds_since_last_ingestion,
  {total("num_rows_migrated")} AS total_rows_inserted,
  {gib("num_bytes_migrated")} AS total_gb_inserted,
  count(DISTINCT date_trunc('minute', end_time)) AS active_minutes_last_hour,
  avg(num_rows_migrated) AS avg_rows_per_insert, max(num_rows_migrated) AS max_rows_per_insert,
  {credits("credits_used")} AS total_credits_used
FROM migration_history WHERE table_name = 'RAW_BADGE_EVENTS' AND end_time >= {HOUR_AGO}
GROUP BY table_name""",
    "v_ingestion_metrics": f"""
SELECT date_trunc('hour', ingestion_time) AS ingestion_hour, count(*) AS event_count,
  {half_up("count(*)", "3600", 6)} AS events_per_second,
  count(DISTINCT badge_id) AS unique_badges, count(DISTINCT zone_id) AS unique_zones,
  {half_up("sum(cast(signal_strength AS bigint))", "count(*)", 2)} AS avg_signal_strength,
  {total("CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END")} AS weak_signal_count,
  {pct("sum(CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END)", "count(*)")}
    AS weak_signal_pct,
  {total("CASE WHEN direction = 'ENTRY' THEN 1 ELSE 0 END")} AS entry_count,
  {total("CASE WHEN direction = 'EXIT' THEN 1 ELSE 0 END")} AS exit_count,
  {total("CASE direction WHEN 'ENTRY' THEN 1 WHEN 'EXIT' THEN -1 ELSE 0 END")}
    AS net_occupancy_change
FROM raw_events WHERE ingestion_time >= {DAY_AGO}
GROUP BY date_trunc('hour', ingestion_time)""",
    "v_end_to_end_latency": f"""
SELECT layer, last_update, date_diff('second', last_update, {AS_OF}) AS seconds_since_update,
  row_count,
  CASE WHEN date_diff('second', last_update, {AS_OF}) > 300 THEN 'STALE'
    WHEN date_diff('second', last_update, {AS_OF}) > 120 THEN 'WARNING' ELSE 'HEALTHY' END
    AS health_status
FROM ({_layer("RAW", "raw_events", "ingestion_time")}
  UNION ALL {_layer("STAGING", "stg_events", "staging_time")}
  UNION ALL {_layer("ANALYTICS", "fct_events", "fact_load_time")})""",
    "v_data_freshness": f"""
{_fresh("RAW_BADGE_EVENTS", "raw_events", "ingestion_time")}
UNION ALL {_fresh("FCT_ACCESS_EVENTS", "fct_events", "fact_load_time")}""",
    "v_data_quality_metrics": f"""
SELECT total_raw_events, total_staged_events, total_fact_events, duplicate_count,
  {pct("duplicate_count", "total_raw_events")} AS duplicate_rate_pct,
  orphan_user_count, orphan_zone_count,
  {pct("orphan_user_count + orphan_zone_count", "total_staged_events")} AS orphan_rate_pct,
  weak_signal_count, {pct("weak_signal_count", "total_raw_events")} AS weak_signal_rate_pct
FROM (SELECT count(*) AS total_raw_events,
    {total("CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END")} AS weak_signal_count
  FROM raw_events WHERE ingestion_time >= {DAY_AGO}) r,
  (SELECT count(*) AS total_staged_events FROM stg_events WHERE staging_time >= {DAY_AGO}) s,
  (SELECT count(*) AS total_fact_events FROM fct_events WHERE fact_load_time >= {DAY_AGO}) f,
  (SELECT cast(coalesce(sum(n - 1), 0) AS bigint) AS duplicate_count FROM
    (SELECT count(*) AS n FROM raw_events WHERE ingestion_time >= {DAY_AGO}
     GROUP BY badge_id, event_timestamp HAVING count(*) > 1)) d,
  (SELECT count(*) FILTER (u.user_id IS NULL) AS orphan_user_count,
    count(*) FILTER (z.zone_id IS NULL) AS orphan_zone_count
   FROM stg_events s LEFT JOIN dim_users u ON s.user_id = u.user_id AND u.is_current
   LEFT JOIN dim_zones z ON s.zone_id = z.zone_id WHERE s.staging_time >= {DAY_AGO}) o""",
    "v_partition_efficiency": f"""
SELECT table_name, {total("num_queries")} AS query_count,
  {pct("sum(partitions_scanned)", "sum(partitions_scanned + partitions_pruned)")}
    AS avg_scan_ratio_pct,
  {half_up("sum(rows_scanned)", "1073741824", 2)} AS total_gb_scanned_approx,
  {pct("sum(rows_pruned)", "sum(rows_scanned + rows_pruned)")} AS row_prune_ratio_pct,
  CASE WHEN {_SCAN_PCT} < 20 THEN 'EXCELLENT' WHEN {_SCAN_PCT} < 50 THEN 'GOOD'
    WHEN {_SCAN_PCT} < 80 THEN 'FAIR' ELSE 'POOR' END AS pruning_efficiency
FROM pruning_history WHERE table_name IN ('RAW_BADGE_EVENTS', 'FCT_ACCESS_EVENTS')
  AND interval_start_time >= {AS_OF_PRUNE} - INTERVAL '1' DAY
GROUP BY table_name""",
    "v_streaming_costs": f"""
SELECT ingestion_date, gb_ingested, rows_ingested, actual_credits_used,
  round(rows_ingested / nullif(gb_ingested, 0), 0) AS rows_per_gb
FROM (SELECT cast(end_time AS date) AS ingestion_date,
    {gib("num_bytes_migrated")} AS gb_ingested, {total("num_rows_migrated")} AS rows_ingested,
    {credits("credits_used")} AS actual_credits_used
  FROM migration_history WHERE table_name = 'RAW_BADGE_EVENTS' AND end_time >= {MONTH_AGO}
  GROUP BY cast(end_time AS date))""",
    "task_runs": f"""
SELECT name AS task_name, state, scheduled_time, completed_time,
  date_diff('second', scheduled_time, completed_time) AS duration_seconds, error_code,
  error_message,
  CASE WHEN state = 'SUCCEEDED' THEN 'SUCCESS' WHEN state = 'FAILED' THEN 'FAILED'
    WHEN state = 'SKIPPED' THEN 'SKIPPED' ELSE 'UNKNOWN' END AS execution_status,
  rows_processed, run_id
FROM (SELECT * FROM task_history WHERE scheduled_time >= {AS_OF_TASKS} - INTERVAL '1' DAY
  ORDER BY scheduled_time DESC, name, database_name, state, completed_time, error_code,
    error_message, rows_processed, run_id LIMIT 1000)
WHERE database_name = 'DEMO'""",
    "every_run": f"""
SELECT name AS task_name, state, scheduled_time, completed_time,
  date_diff('second', scheduled_time, completed_time) AS duration_seconds, error_code,
  error_message,
  CASE WHEN state = 'SUCCEEDED' THEN 'SUCCESS' WHEN state = 'FAILED' THEN 'FAILED'
    WHEN state = 'SKIPPED' THEN 'SKIPPED' ELSE 'UNKNOWN' END AS execution_status,
  rows_processed, run_id
FROM task_history WHERE scheduled_time >= {AS_OF_TASKS} - INTERVAL '4000' DAY
  AND database_name = 'DEMO'""",
    "newest_runs": """
SELECT * FROM task_runs ORDER BY scheduled_time DESC, task_name, state, completed_time,
  duration_seconds, error_code, error_message, execution_status, run_id LIMIT 50""",
    "v_streaming_client_metrics": f"""
SELECT client_name, cast(start_time AS date) AS ingestion_date, count(*) AS session_count,
  {credits("credits_used")} AS total_client_credits,
  {gib("data_sent_bytes")} AS total_gb_sent,
  avg(data_sent_bytes) / pow(1024, 2) AS avg_mb_per_session,
  {total("rows_sent")} AS total_rows_sent,
  avg(date_diff('second', start_time, end_time)) AS avg_session_duration_seconds,
  min(start_time) AS earliest_session, max(end_time) AS latest_session
FROM client_history WHERE start_time >= {MONTH_AGO}
GROUP BY client_name, cast(start_time AS date)""",
}


def with_feeds(sql: str) -> str:
    """Prefix the derived tables the statement mentions, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in TABLES and word not in needed:
                visit(TABLES[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in needed)
    own = re.match(r"\s*WITH\s+", sql)
    rest = f",\n{sql[own.end():]}" if own else f"\n{sql.strip()}"
    return f"WITH {ctes}{rest}"
