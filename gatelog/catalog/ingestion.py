"""Sources and sinks (SRC), projections (PRJ) and scalar functions (FN)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from gatelog import schemas
from gatelog.catalog import expected as x
from gatelog.catalog.feeds import (
    AS_OF,
    AS_OF_TASKS,
    LOAD_TIME,
    SEED_TIME,
    badge_feed,
    json_lines,
)
from gatelog.catalog.registry import query
from gatelog.functions import labels, numbers, times
from gatelog.operators import facts, selection
from gatelog.plans import reports
from gatelog.session import scratch_dir
from gatelog.sources import events
from gatelog.sources.tables import Warehouse, cluster_by_date
from gatelog.streaming import ingest

ONCE = {"availableNow": True}


def new_warehouse(t, purpose: str) -> Warehouse:
    return Warehouse(t.spark, scratch_dir(t.spark, purpose)).create(SEED_TIME)


def landed(t, purpose: str) -> Warehouse:
    """A fresh warehouse with every event streamed into its landing table as JSON."""
    warehouse = new_warehouse(t, purpose)
    lines = json_lines(badge_feed(t.stream("events"))).select("value")
    ingest.start_landing(
        lines, warehouse, warehouse.path("ckpt/landing"), ONCE
    ).awaitTermination()
    return warehouse


def seq():
    """The feed's row number, which travels as an extra JSON field."""
    return F.get_json_object("raw_json", "$.seq").cast("bigint").alias("seq")


# --- SRC --------------------------------------------------------------------------------


@query("src01_streamed_json_events", """
SELECT seq, badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength,
  signal_quality, direction FROM raw_events""")
def _(t):
    raw = landed(t, "landing").raw
    return raw.select(seq(), *schemas.STAGED_COLUMNS[:-1])


@query("src02_json_fields", """
SELECT seq, badge_id, user_id, zone_id, reader_id,
  strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
  signal_in AS signal_strength, direction_in AS direction FROM badge_feed""")
def _(t):
    return events.extract_fields(t.json_lines()).select(
        "seq", "badge_id", "user_id", "zone_id", "reader_id", "event_timestamp",
        F.col("signal_strength").cast("decimal(9,2)").alias("signal_strength"), "direction")


STAMP_FORMS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss'Z'",
               "yyyy-MM-dd'T'HH:mm:ss'-05:00'", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy hh:mm a")


@query("src03_iso_timestamps", """
SELECT event_id AS seq, CASE event_id % 6 WHEN 1 THEN date_trunc('millisecond', ts)
  WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE date_trunc('second', ts) END AS event_timestamp
FROM events""")
def _(t):
    form = F.col("event_id") % len(STAMP_FORMS)
    text = F.lit(None).cast("string")
    for i, pattern in enumerate(STAMP_FORMS):
        text = F.when(form == i, F.date_format("ts", pattern)).otherwise(text)
    return t.source("events").select(
        F.col("event_id").alias("seq"), events.iso_timestamp(text).alias("event_timestamp"))


def parsed(t):
    return events.parse_events(t.json_lines().select("value"), LOAD_TIME)


@query("src04_missing_signal", "SELECT seq, signal_strength FROM raw_events")
def _(t):
    return parsed(t).select(seq(), "signal_strength")


@query("src05_direction_upper", "SELECT seq, direction FROM raw_events")
def _(t):
    return parsed(t).select(seq(), "direction")


@query("src06_signal_quality", """
SELECT signal_quality, count(*) AS events, min(signal_strength) AS weakest,
  max(signal_strength) AS strongest FROM raw_events GROUP BY 1""")
def _(t):
    return parsed(t).groupBy("signal_quality").agg(
        F.count("*").alias("events"), F.min("signal_strength").alias("weakest"),
        F.max("signal_strength").alias("strongest"))


@query("src07_ingestion_stamp", f"""
SELECT {x.stamp(LOAD_TIME)} AS ingestion_time, count(*) AS events FROM badge_feed""")
def _(t):
    return parsed(t).groupBy("ingestion_time").agg(F.count("*").alias("events"))


@query("src08_payload_variant", """
SELECT event_id AS seq, cast(json_extract(props, '$.k') AS integer) AS k FROM events""")
def _(t):
    variant = events.with_variant(parsed(t))
    extra = F.try_parse_json(F.try_variant_get("payload", "$.extra", "string"))
    return variant.select(
        F.try_variant_get("payload", "$.seq", "bigint").alias("seq"),
        F.try_variant_get(extra, "$.k", "int").alias("k"))


def faulty_lines(t):
    """The whole feed as JSON, with a fault by position in each block of 25 events."""
    case = F.col("seq") % 25
    feed = t.badge_feed.select(
        "seq",
        F.when(case != 0, F.col("badge_id")).alias("badge_id"),
        "user_id",
        F.when(case == 1, F.rpad("zone_id", 51, "X")).otherwise(F.col("zone_id"))
        .alias("zone_id"),
        "reader_id",
        F.when(case == 3, F.date_format("event_timestamp", "MM/dd/yyyy hh:mm a"))
        .when(case == 4, F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"))
        .when(case == 8, F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(case == 9, F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(case == 10, F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("event_timestamp"),
        F.when(case == 5, "loud").when(case == 6, "12345")
        .otherwise(F.col("signal_in").cast("string")).alias("signal_strength"),
        F.when(case == 7, "sideways-in").otherwise(F.col("direction_in")).alias("direction"),
    )
    line = F.to_json(F.struct(*feed.columns[1:], "seq"))
    cut = F.substring(line, F.lit(1), F.length(line) - 1)
    return feed.select(F.when(case == 2, cut).otherwise(line).alias("value"))


@query("src09_validated_events", """
SELECT seq, badge_id, event_timestamp, signal_strength, signal_quality, direction
FROM raw_events WHERE seq % 25 >= 8""")
def _(t):
    good, _ = events.validate_events(faulty_lines(t), LOAD_TIME)
    return good.select(seq(), "badge_id", "event_timestamp", "signal_strength",
                       "signal_quality", "direction")


@query("src10_quarantined_events", """
SELECT seq, CASE seq % 25 WHEN 0 THEN 'missing_badge_id' WHEN 1 THEN 'too_long_zone_id'
  WHEN 2 THEN 'malformed_json' WHEN 3 THEN 'bad_event_timestamp'
  WHEN 4 THEN 'bad_event_timestamp' WHEN 5 THEN 'bad_signal_strength'
  WHEN 6 THEN 'signal_strength_out_of_range' ELSE 'too_long_direction' END AS reject_reason
FROM badge_feed WHERE seq % 25 < 8""")
def _(t):
    _, bad = events.validate_events(faulty_lines(t), LOAD_TIME)
    number = F.regexp_extract("value", r'"seq":(\d+)', 1).cast("bigint").alias("seq")
    return bad.select(number, "reject_reason")


@query("src11_seeded_dimensions", """
SELECT user_id, user_name, department, events FROM seed_users
LEFT JOIN (SELECT user_id, count(*) AS events FROM raw_events GROUP BY 1) USING (user_id)
UNION ALL SELECT zone_id, zone_name, zone_type, events FROM dim_zones
LEFT JOIN (SELECT zone_id, count(*) AS events FROM raw_events GROUP BY 1) USING (zone_id)""")
def _(t):
    def used(dim, key, *columns):
        counts = t.raw.groupBy(key).agg(F.count("*").alias("events"))
        return dim.join(counts, key, "left").select(key, *columns, "events")

    users = used(t.seeded_users, "user_id", "user_name", "department")
    return users.union(used(t.zones, "zone_id", "zone_name", "zone_type"))


@query("src12_landing_sink", """
SELECT zone_id, signal_quality, count(*) AS events FROM raw_events GROUP BY 1, 2""")
def _(t):
    raw = landed(t, "landing").raw
    return raw.groupBy("zone_id", "signal_quality").agg(F.count("*").alias("events"))


@query("src13_retry_dedupe", "SELECT seq, badge_id, event_timestamp FROM raw_events")
def _(t):
    feed = badge_feed(t.stream("events"))
    resent = feed.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    once = events.dedupe_retries(resent, "seq", "ingestion_time", timedelta(hours=2))
    path = scratch_dir(t.spark, "retries")
    columns = once.select("seq", "badge_id", "event_timestamp")
    columns.writeStream.format("parquet").option(
        "checkpointLocation", f"{path}/ckpt"
    ).trigger(**ONCE).start(f"{path}/rows").awaitTermination()
    return t.spark.read.parquet(f"{path}/rows")


@query("src13_resent_lines_landed", """
SELECT seq, badge_id, event_timestamp FROM raw_events""")
def _(t):
    """Every line comes twice in a batch and its odd ones again in the next; the row number is the token."""
    warehouse = new_warehouse(t, "resent")
    lines = json_lines(t.badge_feed)
    odd = lines.filter("seq % 2 = 1")
    token = events.Retries("$.seq")
    for batch_id, batch in enumerate((lines.unionByName(lines), odd)):
        warehouse.land(events.classify_events(batch.select("value")), batch_id, token)
    return warehouse.raw.select(seq(), "badge_id", "event_timestamp")


HALVES = ((0, "< DATE '2024-01-16'"), (1, ">= DATE '2024-01-16'"))


@query("src14_staging_sink", """
SELECT CASE WHEN batch_date < DATE '2024-01-16' THEN 0 ELSE 1 END AS batch_id,
  count(*) AS staged FROM (SELECT DISTINCT batch_date < DATE '2024-01-16', badge_id,
    event_timestamp, CASE WHEN batch_date < DATE '2024-01-16' THEN DATE '2024-01-01'
    ELSE DATE '2024-01-16' END AS batch_date FROM stg_events) GROUP BY 1""")
def _(t):
    warehouse = new_warehouse(t, "staging")
    for batch_id, days in HALVES:
        batch = t.raw.filter(f"cast(ingestion_time AS date) {days}")
        staged = facts.stage_batch(batch).withColumn("staging_time", times.ntz(LOAD_TIME))
        for _attempt in range(2):  # a replay replaces the partition
            warehouse.write_staging(staged, batch_id)
    return warehouse.stg.groupBy("batch_id").agg(F.count("*").alias("staged")).withColumn(
        "batch_id", F.col("batch_id").cast("int"))


@query("src15_fact_sink", """
SELECT event_date, count(*) AS events, count(DISTINCT badge_id) AS badges FROM fct_events
WHERE event_date >= DATE '2024-01-10' GROUP BY 1""")
def _(t):
    warehouse = new_warehouse(t, "facts")
    rows = facts.fact_columns(
        cluster_by_date(t.facts), F.monotonically_increasing_id(), LOAD_TIME)
    warehouse.append_facts(rows)
    recent = warehouse.facts.filter(F.col("event_date") >= "2024-01-10")
    return recent.groupBy("event_date").agg(
        F.count("*").alias("events"), F.countDistinct("badge_id").alias("badges"))


@query("src16_run_metadata", """
SELECT min(ingestion_time) AS deployment_timestamp, 'second' AS account_identifier,
  cast(max(ingestion_time) AS date) + 30 AS expires_date FROM raw_events""")
def _(t):
    warehouse = new_warehouse(t, "metadata")
    first, last = t.raw.agg(F.min("ingestion_time"), F.max("ingestion_time")).first()
    for account in ("first", "second"):
        warehouse.write_run_metadata(account, last.date() + timedelta(days=30), first)
    return warehouse.run_metadata


@query("src17_projected_scan", """
SELECT badge_id, event_timestamp, ingestion_time FROM raw_events""")
def _(t):
    return t.raw.select("badge_id", "event_timestamp", "ingestion_time")


@query("src18_landing_loads", """
SELECT 'PARTIALLY_LOADED' AS status, count(*) AS row_count,
  count(*) FILTER (seq % 10 = 0) AS error_count, 'malformed_json' AS first_error_message
FROM raw_events""")
def _(t):
    """Every tenth line of the feed lost its end on the way."""
    warehouse = new_warehouse(t, "faulty")
    lines = json_lines(badge_feed(t.stream("events")))
    cut = F.when(F.col("seq") % 10 == 0, F.expr("left(value, length(value) - 1)"))
    ingest.start_landing(
        lines.select(cut.otherwise(F.col("value")).alias("value")), warehouse,
        warehouse.path("ckpt/landing"), ONCE,
    ).awaitTermination()
    now = ingest.utc_now()
    loads = reports.landing_loads(warehouse.landing, now)
    return reports.load_history(loads, now).select(
        "status", "row_count", "error_count", "first_error_message")


@query("src18_load_history_day", """
SELECT file_name, last_load_time, CASE WHEN error_count = 0 THEN 'LOADED'
  WHEN error_count < row_count THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
  row_count, error_count, first_error_message FROM load_log
WHERE last_load_time >= """ + x.DAY_AGO)
def _(t):
    return reports.load_history(t.load_log, AS_OF, span=timedelta(days=1))


# --- PRJ --------------------------------------------------------------------------------


@query("prj01_aliased_columns", """
SELECT name AS task_name, state AS run_state, scheduled_time AS started FROM task_history""")
def _(t):
    return t.tasks.select(
        F.col("name").alias("task_name"), F.col("state").alias("run_state"),
        F.col("scheduled_time").alias("started"))


SPANS = {
    "5 MINUTE": timedelta(minutes=5), "10 MINUTE": timedelta(minutes=10),
    "1 HOUR": timedelta(hours=1), "1 DAY": timedelta(days=1), "7 DAY": timedelta(days=7),
    "30 DAY": timedelta(days=30),
}


@query("prj02_lookback_windows", " UNION ALL ".join(
    f"SELECT '{span}' AS span, count(*) AS events FROM raw_events "
    f"WHERE ingestion_time >= {x.AS_OF} - INTERVAL {span}" for span in SPANS))
def _(t):
    # One scan: each row is counted in every window it falls into.
    counts = [
        F.count_if(F.col("ingestion_time") >= times.ntz(AS_OF - width)).alias(span)
        for span, width in SPANS.items()
    ]
    widest = times.lookback(t.raw, "ingestion_time", max(SPANS.values()), AS_OF)
    return widest.agg(*counts).unpivot([], list(SPANS), "span", "events")


@query("prj03_in_and_equality", """
SELECT table_name, count(*) AS entries FROM pruning_history
WHERE table_name IN ('RAW_BADGE_EVENTS', 'FCT_ACCESS_EVENTS') AND num_queries = 3 GROUP BY 1""")
def _(t):
    wanted = F.col("table_name").isin("RAW_BADGE_EVENTS", "FCT_ACCESS_EVENTS")
    return t.pruning.filter(wanted & (F.col("num_queries") == 3)).groupBy("table_name").agg(
        F.count("*").alias("entries"))


@query("prj04_null_or_not_in", """
SELECT seq, user_id, direction FROM raw_events WHERE direction IS NULL
  OR user_id NOT IN (SELECT user_id FROM seed_users)""")
def _(t):
    known = t.seeded_users.select("user_id").distinct().withColumn("_known", F.lit(True))
    flagged = t.raw.join(known, "user_id", "left")
    return flagged.filter("direction IS NULL OR _known IS NULL").select(
        "seq", "user_id", "direction")


DATE_PARTS = """SELECT seq, cast(event_timestamp AS date) AS event_date,
  cast(hour(event_timestamp) AS integer) AS event_hour,
  cast(dayofweek(event_timestamp) AS integer) AS event_day_of_week,
  hour(event_timestamp) < 6 OR hour(event_timestamp) >= 22 AS is_after_hours,
  dayofweek(event_timestamp) IN (0, 6) AS is_weekend FROM raw_events"""


def dated(t):
    return facts.date_parts(t.raw)


@query("prj05_date_parts",
       f"SELECT seq, event_date, event_hour, event_day_of_week FROM ({DATE_PARTS})")
def _(t):
    return dated(t).select("seq", "event_date", "event_hour", "event_day_of_week")


@query("prj06_after_hours", f"""
SELECT event_hour, is_after_hours, count(*) AS events FROM ({DATE_PARTS}) GROUP BY 1, 2""")
def _(t):
    return dated(t).groupBy("event_hour", "is_after_hours").agg(F.count("*").alias("events"))


@query("prj07_weekend", f"""
SELECT event_day_of_week, is_weekend, count(*) AS events FROM ({DATE_PARTS}) GROUP BY 1, 2""")
def _(t):
    return dated(t).groupBy("event_day_of_week", "is_weekend").agg(
        F.count("*").alias("events"))


@query("prj08_restricted_access", """
SELECT f.zone_id, z.is_restricted AS is_restricted_access, count(*) AS events
FROM fct_events f JOIN dim_zones z USING (zone_id) GROUP BY 1, 2""")
def _(t):
    return t.facts.groupBy("zone_id", "is_restricted_access").agg(
        F.count("*").alias("events"))


@query("prj09_status_bands", f"""
SELECT seconds, CASE WHEN seconds > 300 THEN 'STALE' WHEN seconds > 120 THEN 'WARNING'
    ELSE 'HEALTHY' END AS health,
  CASE WHEN seconds < 20 THEN 'EXCELLENT' WHEN seconds < 50 THEN 'GOOD'
    WHEN seconds < 80 THEN 'FAIR' ELSE 'POOR' END AS pruning,
  CASE state WHEN 'SUCCEEDED' THEN 'SUCCESS' ELSE state END AS execution, count(*) AS runs
FROM (SELECT CASE WHEN run_id % 11 > 0 THEN (run_id * 7) % 400 END AS seconds, state
  FROM task_history) GROUP BY ALL""")
def _(t):
    seconds = F.when(F.col("run_id") % 11 > 0, (F.col("run_id") * 7) % 400)
    return t.tasks.select(seconds.alias("seconds"), "state").groupBy(
        "seconds",
        labels.health_band(F.col("seconds")).alias("health"),
        labels.pruning_band(F.col("seconds")).alias("pruning"),
        labels.execution_band(F.col("state")).alias("execution"),
    ).agg(F.count("*").alias("runs"))


@query("prj10_badge_lookup", """
SELECT badge_id, user_id, zone_id, event_timestamp, signal_strength, signal_quality,
  ingestion_time FROM raw_events WHERE badge_id = 'BADGE-000002'
ORDER BY ingestion_time DESC, user_id, zone_id, event_timestamp, signal_strength LIMIT 25""")
def _(t):
    return selection.events_for_badge(t.raw, "BADGE-000002", 25)


# --- FN ---------------------------------------------------------------------------------


@query("fn01_as_of", f"""
SELECT date_diff('day', cast(ingestion_time AS date), cast({x.AS_OF} AS date)) AS days_ago,
  count(*) AS events, max({x.AS_OF}) AS as_of FROM raw_events GROUP BY 1""")
def _(t):
    today = F.to_date(times.ntz(AS_OF))
    days = F.datediff(today, F.to_date("ingestion_time")).cast("bigint")
    return t.raw.groupBy(days.alias("days_ago")).agg(
        F.count("*").alias("events"), F.max(times.ntz(AS_OF)).alias("as_of"))


@query("fn02_date_add", """
SELECT seq, ingestion_time + INTERVAL '90' MINUTE AS later,
  ingestion_time - INTERVAL '1' DAY AS earlier FROM raw_events""")
def _(t):
    stamp = F.col("ingestion_time")
    return t.raw.select(
        "seq", (stamp + F.expr("INTERVAL 90 MINUTE")).alias("later"),
        (stamp - F.expr("INTERVAL 1 DAY")).alias("earlier"))


@query("fn03_second_boundaries", """
SELECT event_id AS seq, date_diff('second', ts, ts + INTERVAL '1' MILLISECOND * (event_id % 7000))
  AS seconds FROM events""")
def _(t):
    millis = F.make_dt_interval(secs=(F.col("event_id") % 7000 / 1000).cast("decimal(18,6)"))
    return t.source("events").select(
        F.col("event_id").alias("seq"),
        times.seconds_between(F.col("ts"), F.col("ts") + millis).alias("seconds"))


@query("fn04_days_between", f"""
SELECT run_id, date_diff('day', scheduled_time, {x.AS_OF_TASKS}) AS days FROM task_history""")
def _(t):
    days = F.datediff(times.ntz(AS_OF_TASKS), F.col("scheduled_time")).cast("bigint")
    return t.tasks.select("run_id", days.alias("days"))


@query("fn05_truncated_times", """
SELECT event_id AS seq, date_trunc('minute', ts)::timestamp AS minute,
  date_trunc('hour', ts)::timestamp AS hour, date_trunc('day', ts)::timestamp AS day
FROM events""")
def _(t):
    return t.source("events").select(
        F.col("event_id").alias("seq"),
        *[times.truncate(unit, F.col("ts")).alias(unit) for unit in ("minute", "hour", "day")])


@query("fn06_calendar_parts", """
SELECT event_id AS seq, cast(ts AS date) AS day, cast(hour(ts) AS integer) AS hour,
  cast(dayofweek(ts) AS integer) AS day_of_week FROM events""")
def _(t):
    ts = F.col("ts")
    return t.source("events").select(
        F.col("event_id").alias("seq"), F.to_date(ts).alias("day"),
        F.hour(ts).alias("hour"), times.day_of_week(ts).alias("day_of_week"))


@query("fn07_text_to_time", """
SELECT event_id AS seq, CASE WHEN event_id % 3 > 0 THEN ts END AS moment,
  cast(ts AS date) AS day FROM events""")
def _(t):
    text = F.when(F.col("event_id") % 3 > 0, F.col("ts").cast("string")).otherwise("n/a")
    return t.source("events").select(
        F.col("event_id").alias("seq"), text.try_cast("timestamp_ntz").alias("moment"),
        F.substring(F.col("ts").cast("string"), 1, 10).try_cast("date").alias("day"))


@query("fn08_text_functions", """
SELECT seq, upper(direction_in) AS upper, lower(zone_id) AS lower,
  replace(badge_id, 'BADGE-', '') AS number, user_id || '@' || zone_id AS place
FROM badge_feed""")
def _(t):
    return t.badge_feed.select(
        "seq", F.upper("direction_in").alias("upper"), F.lower("zone_id").alias("lower"),
        F.replace("badge_id", F.lit("BADGE-"), F.lit("")).alias("number"),
        F.concat("user_id", F.lit("@"), "zone_id").alias("place"))


@query("fn09_conditionals", """
SELECT seq, coalesce(direction_in, 'none') AS direction, nullif(zone_id, 'ZONE-UNKNOWN') AS zone,
  signal_in IS NULL AS missing, CASE user_id WHEN 'USR-001' THEN 1 WHEN 'USR-002' THEN 2 END
  AS simple FROM badge_feed""")
def _(t):
    user = F.col("user_id")
    return t.badge_feed.select(
        "seq", F.coalesce("direction_in", F.lit("none")).alias("direction"),
        F.nullif("zone_id", F.lit("ZONE-UNKNOWN")).alias("zone"),
        F.when(F.col("signal_in").isNull(), True).otherwise(False).alias("missing"),
        F.when(user == "USR-001", 1).when(user == "USR-002", 2).alias("simple"))


@query("fn10_round_and_power", """
SELECT seq, cast(round(signal_in, 1) AS decimal(9,1)) AS rounded,
  seq / pow(1024, 2) AS scaled FROM badge_feed""")
def _(t):
    return t.badge_feed.select(
        "seq", F.round("signal_in", 1).cast("decimal(9,1)").alias("rounded"),
        (F.col("seq") / F.pow(F.lit(1024.0), F.lit(2.0))).alias("scaled"))


@query("fn11_casts_and_paths", """
SELECT seq, cast(signal_in AS decimal(38,0)) AS whole, cast(seq AS varchar) AS text,
  cast(json_extract(extra_json, '$.k') AS bigint) AS k FROM badge_feed""")
def _(t):
    return t.badge_feed.select(
        "seq", events.whole_signal(F.col("signal_in").cast("string")).alias("whole"),
        F.col("seq").cast("string").alias("text"),
        F.get_json_object("extra_json", "$.k").cast("bigint").alias("k"))


@query("fn12_count_arithmetic", f"""
SELECT zone_id, count(*) - count(direction) AS without_direction,
  {x.half_up("count(*)", "3600", 6)} AS per_second, count(*) * 2 + 1 AS odd
FROM raw_events GROUP BY 1""")
def _(t):
    n = F.count("*")
    return t.raw.groupBy("zone_id").agg(
        (n - F.count("direction")).alias("without_direction"),
        numbers.ratio(n, F.lit(3600), 6).alias("per_second"), (n * 2 + 1).alias("odd"))


@query("fn13_humanized_ages", f"""
SELECT seq, {x.humanize("s")} AS age FROM (SELECT seq, CASE WHEN seq % 9 > 0
  THEN seq * 37 % 90000 END AS s FROM raw_events)""")
def _(t):
    seconds = F.when(F.col("seq") % 9 > 0, F.col("seq") * 37 % 90000)
    return t.raw.select("seq", labels.humanize_seconds(seconds).alias("age"))


@query("fn14_status_colors", f"""
SELECT status, {x.color("status")} AS color, count(*) AS runs FROM (SELECT
  CASE WHEN run_id % 5 = 0 THEN 'HEALTHY' WHEN run_id % 5 = 1 THEN 'WARNING'
    WHEN run_id % 5 = 2 THEN 'STALE' WHEN run_id % 5 = 3 THEN state END AS status
  FROM task_history) GROUP BY 1""")
def _(t):
    kind = F.col("run_id") % 5
    status = F.when(kind == 0, "HEALTHY").when(kind == 1, "WARNING").when(kind == 2, "STALE")
    runs = t.tasks.select(status.when(kind == 3, F.col("state")).alias("status"))
    return runs.groupBy("status").agg(F.count("*").alias("runs")).withColumn(
        "color", labels.health_color(F.col("status")))
