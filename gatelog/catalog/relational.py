"""Joins (JOIN), aggregations (AGG), windows (WIN), sorts (SRT) and unions (SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatelog.catalog import expected as x
from gatelog.catalog.feeds import AS_OF, AS_OF_TASKS, truncated
from gatelog.catalog.registry import query
from gatelog.functions import numbers, times
from gatelog.operators import dims, facts, selection, sequences
from gatelog.operators.selection import newest_first, top_n
from gatelog.plans import kpis, reports, views

N = "count(*)"

# --- JOIN -------------------------------------------------------------------------------


@query("join01_current_users", """
SELECT s.seq, u.user_name, u.department FROM stg_events s
JOIN dim_users u ON s.user_id = u.user_id AND u.is_current""")
def _(t):
    users = dims.current(t.users).select("user_id", "user_name", "department")
    return t.stg.join(users, "user_id").select("seq", "user_name", "department")


@query("join02_known_zones", """
SELECT s.seq, s.zone_id, z.is_restricted AS is_restricted_access,
  cast(event_timestamp AS date) AS event_date
FROM stg_events s JOIN dim_zones z ON s.zone_id = z.zone_id
JOIN dim_users u ON s.user_id = u.user_id AND u.is_current""")
def _(t):
    return facts.enrich(t.stg, t.users, t.zones).select(
        "seq", "zone_id", "is_restricted_access", "event_date")


@query("join03_unloaded_events", """
SELECT s.badge_id, s.event_timestamp, s.seq FROM stg_events s
LEFT JOIN fct_events f ON s.badge_id = f.badge_id AND s.event_timestamp = f.event_timestamp
WHERE f.badge_id IS NULL""")
def _(t):
    rows = facts.load_facts(t.stg, t.users, t.zones, t.facts, how="left")
    return rows.select("badge_id", "event_timestamp", "seq")


@query("join04_left_lookup", """
SELECT s.seq, u.user_name, z.zone_name FROM stg_events s
LEFT JOIN seed_users u ON s.user_id = u.user_id AND u.is_current
LEFT JOIN dim_zones z ON s.zone_id = z.zone_id""")
def _(t):
    users = dims.current(t.seeded_users).select("user_id", "user_name")
    zones = t.zones.select("zone_id", "zone_name")
    joined = t.stg.join(zones, "zone_id", "left").join(users, "user_id", "left")
    return joined.select("seq", "user_name", "zone_name")


@query("join05_single_row_aggregates", """
SELECT r.raw_events, s.staged_events, f.fact_events
FROM (SELECT count(*) AS raw_events FROM raw_events) r
CROSS JOIN (SELECT count(*) AS staged_events FROM stg_events) s
CROSS JOIN (SELECT count(*) AS fact_events FROM fct_events) f""")
def _(t):
    return views.one_row(
        t.raw.agg(F.count("*").alias("raw_events")),
        t.stg.agg(F.count("*").alias("staged_events")),
        t.facts.agg(F.count("*").alias("fact_events")))


@query("join06_null_aware_not_in", """
SELECT DISTINCT zone_id FROM raw_events WHERE zone_id NOT IN (SELECT zone_id FROM dim_zones)""")
def _(t):
    return dims.orphan_ids(t.raw, t.zones, "zone_id")


@query("join07_insert_only_merge", """
SELECT user_id, user_name, user_type, department, clearance_level, is_active, is_current
FROM dim_users WHERE user_name = 'UNKNOWN'""")
def _(t):
    return reports.user_listing(t).filter("user_name = 'UNKNOWN'")


@query("join08_joined_aggregates", """
SELECT a.badge_id, a.events, b.staged FROM
  (SELECT badge_id, count(*) AS events FROM raw_events GROUP BY 1) a
  LEFT JOIN (SELECT badge_id, count(*) AS staged FROM stg_events
    WHERE direction = 'ENTRY' GROUP BY 1) b ON a.badge_id = b.badge_id""")
def _(t):
    events = t.raw.groupBy("badge_id").agg(F.count("*").alias("events"))
    entries = t.stg.filter("direction = 'ENTRY'")
    return events.join(
        entries.groupBy("badge_id").agg(F.count("*").alias("staged")), "badge_id", "left")


# --- AGG --------------------------------------------------------------------------------


@query("agg01_time_buckets", " UNION ALL ".join(
    f"SELECT '{unit}' AS unit, date_trunc('{unit}', ingestion_time)::timestamp AS bucket, "
    f"{N} AS events FROM raw_events GROUP BY 2" for unit in ("minute", "hour", "day")))
def _(t):
    # One scan and one exchange of minutes; hours and days are rolled up from them.
    minutes = t.raw.groupBy(truncated("minute", "ingestion_time").alias("bucket")).agg(
        F.count("*").alias("events"))
    units = F.explode(F.array(*[F.lit(u) for u in ("minute", "hour", "day")]))
    each = minutes.withColumn("unit", units)
    bucket = F.coalesce(*[
        F.when(F.col("unit") == u, times.truncate(u, F.col("bucket")))
        for u in ("minute", "hour", "day")])
    return each.groupBy("unit", bucket.alias("bucket")).agg(F.sum("events").alias("events"))


@query("agg02_group_by_keys", f"""
SELECT user_id, zone_id, direction, {N} AS events FROM raw_events GROUP BY 1, 2, 3""")
def _(t):
    return t.raw.groupBy("user_id", "zone_id", "direction").agg(F.count("*").alias("events"))


@query("agg03_global_over_no_rows", f"""
SELECT {N} AS events, max(ingestion_time) AS newest, count(DISTINCT badge_id) AS badges,
  {x.total("1")} AS ones FROM raw_events WHERE ingestion_time > {x.AS_OF}""")
def _(t):
    later = t.raw.filter(F.col("ingestion_time") > times.ntz(AS_OF))
    return later.agg(
        F.count("*").alias("events"), F.max("ingestion_time").alias("newest"),
        F.countDistinct("badge_id").alias("badges"), F.sum(F.lit(1)).alias("ones"))


@query("agg04_basic_aggregates", f"""
SELECT name, {N} AS runs, {x.total("rows_processed")} AS rows, avg(rows_processed) AS mean,
  min(scheduled_time) AS first, max(completed_time) AS last FROM task_history GROUP BY 1""")
def _(t):
    return t.tasks.groupBy("name").agg(
        F.count("*").alias("runs"), F.sum("rows_processed").alias("rows"),
        F.avg("rows_processed").alias("mean"), F.min("scheduled_time").alias("first"),
        F.max("completed_time").alias("last"))


@query("agg05_exact_distinct", """
SELECT count(DISTINCT badge_id) AS badges, count(DISTINCT user_id) AS users,
  count(DISTINCT zone_id) AS zones FROM raw_events""")
def _(t):
    return t.raw.agg(
        F.countDistinct("badge_id").alias("badges"), F.countDistinct("user_id").alias("users"),
        F.countDistinct("zone_id").alias("zones"))


@query("agg06_conditional_sum", f"""
SELECT zone_id, {x.total("CASE WHEN direction = 'ENTRY' THEN 1 ELSE 0 END")} AS entries,
  {x.total("CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END")} AS weak
FROM raw_events GROUP BY 1""")
def _(t):
    return t.raw.groupBy("zone_id").agg(
        numbers.sum_if(F.col("direction") == "ENTRY").alias("entries"),
        numbers.sum_if(F.col("signal_quality") == "WEAK").alias("weak"))


@query("agg07_count_if", """
SELECT user_id, count(*) FILTER (direction IS NULL) AS without_direction FROM raw_events
GROUP BY 1""")
def _(t):
    return t.raw.groupBy("user_id").agg(
        F.count_if(F.col("direction").isNull()).alias("without_direction"))


@query("agg08_duplicate_count", """
SELECT cast(coalesce(sum(n - 1), 0) AS bigint) AS duplicate_count FROM
  (SELECT count(*) AS n FROM raw_events GROUP BY badge_id, event_timestamp
   HAVING count(*) > 1)""")
def _(t):
    surplus = F.sum(F.col("copies") - 1)
    return selection.duplicate_keys(t.raw).agg(
        F.coalesce(surplus, F.lit(0)).alias("duplicate_count"))


@query("agg09_distinct_rows", "SELECT DISTINCT user_id, zone_id FROM stg_events")
def _(t):
    return t.stg.select("user_id", "zone_id").distinct()


@query("agg10_active_minutes", """
SELECT zone_id, count(DISTINCT date_trunc('minute', ingestion_time)) AS active_minutes
FROM raw_events GROUP BY 1""")
def _(t):
    return t.raw.groupBy("zone_id").agg(
        F.countDistinct(truncated("minute", "ingestion_time")).alias("active_minutes"))


WEAK = "sum(CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END)"


@query("agg11_safe_ratio", f"""
SELECT zone_id, {x.pct(WEAK, "count(*)")} AS weak_pct,
  {x.pct(WEAK, "count(*) - count(*)")} AS no_base FROM raw_events GROUP BY 1""")
def _(t):
    weak, n = numbers.sum_if(F.col("signal_quality") == "WEAK"), F.count("*")
    return t.raw.groupBy("zone_id").agg(
        numbers.pct(weak, n).alias("weak_pct"), numbers.pct(weak, n - n).alias("no_base"))


@query("agg12_unit_scaling", f"""
SELECT client_name, {x.gib("data_sent_bytes")} AS gb,
  {x.total("data_sent_bytes")} / pow(1024, 2) AS mb,
  {x.half_up("sum(rows_sent)", "3600", 6)} AS per_second,
  {x.half_up("sum(rows_sent)", "10", 6)} AS per_minute FROM client_history GROUP BY 1""")
def _(t):
    size, rows = F.sum("data_sent_bytes"), F.sum("rows_sent")
    return t.clients.groupBy("client_name").agg(
        numbers.gib(size).alias("gb"), numbers.mib(size).alias("mb"),
        numbers.ratio(rows, F.lit(3600), 6).alias("per_second"),
        numbers.ratio(rows, F.lit(10), 6).alias("per_minute"))


@query("agg13_percentile", """
SELECT name, round(quantile_cont(cast(date_diff('second', scheduled_time, completed_time)
  AS double), 0.95), 6) AS p95 FROM task_history GROUP BY 1""")
def _(t):
    seconds = times.seconds_between(F.col("scheduled_time"), F.col("completed_time"))
    per_second = t.tasks.groupBy("name", seconds.alias("s")).agg(F.count("*").alias("n"))
    return per_second.groupBy("name").agg(
        F.round(F.percentile("s", 0.95, F.col("n")), 6).alias("p95"))


# --- WIN --------------------------------------------------------------------------------


@query("win01_latest_copy", """
SELECT seq, badge_id, event_timestamp, zone_id, signal_strength FROM raw_events
QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp
  ORDER BY ingestion_time DESC, seq DESC) = 1""")
def _(t):
    return selection.latest_per_key(t.raw).select(
        "seq", "badge_id", "event_timestamp", "zone_id", "signal_strength")


@query("win02_latest_per_badge", """
SELECT badge_id, user_id, zone_id, event_timestamp, seq FROM raw_events
QUALIFY row_number() OVER (PARTITION BY badge_id
  ORDER BY event_timestamp DESC, ingestion_time DESC, seq DESC) = 1""")
def _(t):
    order = [F.col(c).desc() for c in ("event_timestamp", "ingestion_time", "seq")]
    return selection.first_per_key(t.raw, ["badge_id"], order).select(
        "badge_id", "user_id", "zone_id", "event_timestamp", "seq")


PREVIOUS = "lag({v}) OVER (ORDER BY {o})"


@query("win03_hourly_drop", f"""
SELECT ingestion_hour, event_count, {PREVIOUS.format(v="event_count", o="ingestion_hour")}
  AS previous_event_count FROM v_ingestion_metrics""")
def _(t):
    hourly = views.ingestion_metrics(t, AS_OF).select("ingestion_hour", "event_count")
    return sequences.with_previous(hourly, "ingestion_hour", "event_count")


@query("win04_daily_change", """
SELECT ingestion_date, rows_ingested, 100 * (cast(rows_ingested AS double) - p)
  / nullif(p, 0) AS change_pct FROM (SELECT *, lag(rows_ingested) OVER (
  ORDER BY ingestion_date) AS p FROM v_streaming_costs)""")
def _(t):
    daily = views.streaming_costs(t, AS_OF).select("ingestion_date", "rows_ingested")
    compared = sequences.with_previous(daily, "ingestion_date", "rows_ingested")
    change = sequences.change_pct(F.col("rows_ingested"), F.col("previous_rows_ingested"))
    return compared.select("ingestion_date", "rows_ingested", change.alias("change_pct"))


@query("win05_idle_runs", """
SELECT user_name, hour, min(day) AS first_day, max(day) AS last_day, count(*) AS days
FROM (SELECT *, sum(CASE WHEN n > 2 THEN 0 ELSE 1 END) OVER (PARTITION BY user_name, hour
    ORDER BY day ROWS UNBOUNDED PRECEDING) AS grp
  FROM (SELECT user_name, total_elapsed_ms % 24 AS hour, start_time AS day, count(*) AS n
    FROM query_history GROUP BY 1, 2, 3))
WHERE n > 2 GROUP BY user_name, hour, grp""")
def _(t):
    hour = (F.col("total_elapsed_ms") % 24).alias("hour")
    daily = t.queries.groupBy("user_name", hour, F.col("start_time").alias("day")).agg(
        F.count("*").alias("n"))
    busy = sequences.runs(daily, ["user_name", "hour"], [F.col("day")], F.col("n") > 2)
    return busy.groupBy("user_name", "hour", "run").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count("*").alias("days")).drop("run")


# --- SRT --------------------------------------------------------------------------------


@query("srt01_multi_key_order", """
SELECT client_name, ingestion_date, total_rows_sent FROM v_streaming_client_metrics""")
def _(t):
    metrics = views.streaming_client_metrics(t, AS_OF)
    return metrics.select("client_name", "ingestion_date", "total_rows_sent").orderBy(
        newest_first("ingestion_date"), "client_name")


@query("srt02_ranked_order", "SELECT layer, row_count FROM v_end_to_end_latency")
def _(t):
    return views.end_to_end_latency(t, AS_OF).select("layer", "row_count")


@query("srt03_top_n", " UNION ALL ".join(
    f"SELECT {n} AS n, count(*) AS rows, min(ingestion_time) AS oldest FROM (SELECT * FROM "
    f"raw_events ORDER BY ingestion_time DESC, badge_id LIMIT {n})"
    for n in (5, 10, 20, 24, 30, 50)))
def _(t):
    # The largest list contains the others: one scan, then ranks within 50 rows.
    stamps = t.raw.select("ingestion_time", "badge_id")
    newest = stamps.orderBy(newest_first("ingestion_time"), "badge_id").limit(50)
    listed = newest.agg(F.sort_array(F.collect_list("ingestion_time"), asc=False).alias("ts"))
    sizes = F.explode(F.array(*[F.lit(n) for n in (5, 10, 20, 24, 30, 50)]))
    kept = F.slice("ts", F.lit(1), F.col("n"))
    return listed.select("ts", sizes.alias("n")).select(
        "n", F.size(kept).cast("bigint").alias("rows"), F.array_min(kept).alias("oldest"))


@query("srt04_failures_first", """
SELECT task_name, execution_status, scheduled_time, run_id FROM (SELECT * FROM newest_runs
  ORDER BY execution_status, scheduled_time DESC, task_name, state, completed_time,
    duration_seconds, error_code, error_message, run_id LIMIT 20)""")
def _(t):
    runs = kpis.newest_runs(t, AS_OF_TASKS)
    status = F.col("execution_status").asc_nulls_last()
    ordered = top_n(runs, 20, status, newest_first("scheduled_time"))
    return ordered.select("task_name", "execution_status", "scheduled_time", "run_id")


# --- SET --------------------------------------------------------------------------------


@query("set01_union_of_layers", """
SELECT 'RAW' AS layer, count(*) AS rows FROM raw_events UNION ALL
SELECT 'STAGING', count(*) FROM stg_events UNION ALL
SELECT 'ANALYTICS', count(*) FROM fct_events""")
def _(t):
    layers = (("RAW", t.raw), ("STAGING", t.stg), ("ANALYTICS", t.facts))
    counted = [
        df.agg(F.lit(name).alias("layer"), F.count("*").alias("rows")) for name, df in layers]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("set02_nested_tables", """
WITH daily AS (SELECT cast(ingestion_time AS date) AS day, badge_id, count(*) AS n
  FROM raw_events GROUP BY 1, 2),
busiest AS (SELECT day, max(n) AS most FROM daily GROUP BY 1)
SELECT daily.day, count(*) AS badges, max(most) AS most FROM daily JOIN busiest
  ON daily.day = busiest.day AND daily.n = busiest.most GROUP BY 1""")
def _(t):
    daily = t.raw.groupBy(F.to_date("ingestion_time").alias("day"), "badge_id").agg(
        F.count("*").alias("n"))
    sizes = daily.groupBy("day", "n").agg(F.count("*").alias("badges"))
    return sizes.groupBy("day").agg(
        F.max_by("badges", "n").alias("badges"), F.max("n").alias("most"))


