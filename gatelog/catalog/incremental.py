"""Incremental, streaming and stateful operators (INC), run on a fresh warehouse each."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gatelog.catalog import expected as x
from gatelog.catalog.feeds import LOAD_TIME, Feeds, badge_feed
from gatelog.catalog.ingestion import ONCE, landed, new_warehouse
from gatelog.catalog.registry import query
from gatelog.functions.times import ntz
from gatelog.operators import dims, facts, selection
from gatelog.plans import reports
from gatelog.plans.views import one_row
from gatelog.session import scratch_dir
from gatelog.streaming import ingest

# What one batch over all events stages: copies arrive together, so the payload decides.
ONE_BATCH = """(SELECT * FROM raw_events QUALIFY row_number() OVER (
  PARTITION BY badge_id, event_timestamp ORDER BY user_id DESC, zone_id DESC,
  reader_id DESC, signal_strength DESC, signal_quality DESC, direction DESC) = 1)"""


LATEST = """(SELECT * FROM raw_events QUALIFY row_number() OVER (
  PARTITION BY badge_id, event_timestamp ORDER BY ingestion_time DESC, seq DESC) = 1)"""


def loaded(t, purpose: str):
    """A warehouse after landing the event stream and loading its change feed."""
    warehouse = landed(t, purpose)
    changes = ingest.read_changes(warehouse)
    ingest.start_load(
        changes, warehouse, warehouse.path("ckpt/load"), ONCE
    ).awaitTermination()
    return warehouse


def described(warehouse):
    """Facts with the ids their keys stand for."""
    users = warehouse.users.select("user_key", "user_id")
    zones = warehouse.zones.select("zone_key", "zone_id")
    named = warehouse.facts.join(users, "user_key").join(zones, "zone_key")
    return named.select(
        "badge_id", "event_timestamp", "user_id", "zone_id", "signal_strength", "direction",
        "event_date", "is_weekend", "is_after_hours", "is_restricted_access")


ONE_BATCH_FACTS = f"""SELECT badge_id, event_timestamp, user_id, zone_id, signal_strength,
  direction, cast(event_timestamp AS date) AS event_date,
  dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
  hour(event_timestamp) < 6 OR hour(event_timestamp) >= 22 AS is_after_hours,
  is_restricted AS is_restricted_access
FROM {ONE_BATCH} s JOIN dim_zones z USING (zone_id)"""


@query("inc01_change_feed", f"""
SELECT seq, badge_id, event_timestamp FROM raw_events WHERE seq % 3 > 0""")
def _(t):
    kind = F.when(F.col("seq") % 3 == 0, "delete").otherwise("insert")
    return ingest.only_inserts(t.raw.withColumn("_change_type", kind)).select(
        "seq", "badge_id", "event_timestamp")


@query("inc02_skip_empty_batch", """
SELECT count(*) AS staged, cast(1 AS bigint) AS runs FROM
  (SELECT DISTINCT badge_id, event_timestamp FROM raw_events)""")
def _(t):
    warehouse = new_warehouse(t, "empty-batch")
    nothing = t.raw.filter(F.col("ingestion_time") > ntz(LOAD_TIME + timedelta(days=365)))
    for batch_id, batch in enumerate((nothing, t.raw, nothing)):
        ingest.run_batch(warehouse, batch, batch_id, LOAD_TIME)
    staged = warehouse.stg.agg(F.count("*").alias("staged"))
    runs = warehouse.batch_log.filter(F.col("name") == ingest.STAGE_TASK)
    return one_row(staged, runs.agg(F.count("*").alias("runs")))


@query("inc03_micro_batch_load", ONE_BATCH_FACTS)
def _(t):
    return described(loaded(t, "micro-batch"))


SLICES = ("< DATE '2024-01-11'", "BETWEEN DATE '2024-01-11' AND DATE '2024-01-20'",
          "> DATE '2024-01-20'")


def slices(t):
    """The raw events as three batches by ingestion day."""
    return [(i, t.raw.filter(f"cast(ingestion_time AS date) {s}")) for i, s in enumerate(SLICES)]


def batches(t, batch: str, n: int):
    """The raw events as ``n`` batches by an expression.

    The feed is computed and written once, a folder per batch, and a batch reads its own folder: its
    cost follows its rows, not those of all batches.
    """
    path = scratch_dir(t.spark, "batches")
    rows = t.raw.withColumn("_batch", F.expr(batch))
    rows.write.partitionBy("_batch").parquet(path)
    written = t.spark.read.schema(rows.schema).parquet(path)
    return [(i, written.filter(F.col("_batch") == i).drop("_batch")) for i in range(n)]


SLICE = "CASE " + " ".join(
    f"WHEN cast(ingestion_time AS date) {s} THEN {i}" for i, s in enumerate(SLICES)) + " END"


BY_SLICE = "(" + " UNION ALL ".join(
    f"SELECT *, {i} AS batch_id FROM raw_events WHERE cast(ingestion_time AS date) {s} "
    "QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp "
    "ORDER BY ingestion_time DESC, seq DESC) = 1" for i, s in enumerate(SLICES)) + ")"
SLICE_FACTS = f"""(SELECT * FROM {BY_SLICE} WHERE zone_id IN ({x.KNOWN_ZONES})
  QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp ORDER BY batch_id) = 1)"""


def run_slices(t, purpose: str, options=ingest.LoadOptions(), replay: bool = False):
    warehouse = new_warehouse(t, purpose)
    for batch_id, batch in batches(t, SLICE, len(SLICES)):
        for _attempt in range(2 if replay else 1):
            ingest.run_batch(warehouse, batch, batch_id, LOAD_TIME, options)
    return warehouse


@query("inc04_chained_steps", f"""
SELECT 'raw_to_staging_task' AS name, cast(batch_id AS bigint) AS batch_id,
  'SUCCEEDED' AS state, count(*) AS rows_processed FROM {BY_SLICE} GROUP BY batch_id
UNION ALL SELECT 'staging_to_analytics_task', cast(batch_id AS bigint), 'SUCCEEDED', count(*)
FROM {SLICE_FACTS} GROUP BY batch_id""")
def _(t):
    log = run_slices(t, "chained").batch_log
    return log.select("name", "batch_id", "state", "rows_processed")


@query("inc05_batch_dedupe", f"""
SELECT seq, batch_id, badge_id, event_timestamp, zone_id FROM {BY_SLICE}""")
def _(t):
    staged = [
        facts.stage_batch(batch).withColumn("batch_id", F.lit(i)) for i, batch in slices(t)]
    both = staged[0].unionByName(staged[1]).unionByName(staged[2])
    return both.select("seq", "batch_id", "badge_id", "event_timestamp", "zone_id")


@query("inc06_incremental_facts", f"""
SELECT badge_id, event_timestamp, user_id, zone_id, signal_strength FROM {SLICE_FACTS}""")
def _(t):
    return described(run_slices(t, "replayed", replay=True)).select(
        "badge_id", "event_timestamp", "user_id", "zone_id", "signal_strength")


LATE_ZONE = "ZONE-LOBBY-1"  # not in the zone table until two batches are loaded


@query("inc06_late_zones", f"""
SELECT badge_id, event_timestamp, user_id, zone_id, signal_strength
FROM (SELECT * FROM {BY_SLICE} WHERE zone_id IN ({x.KNOWN_ZONES})
  QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp, CASE
    WHEN batch_id < 2 AND zone_id = '{LATE_ZONE}' THEN batch_id ELSE -1 END
    ORDER BY batch_id) = 1) s
WHERE NOT (zone_id = '{LATE_ZONE}' AND batch_id < 2 AND EXISTS (
  SELECT 1 FROM {BY_SLICE} o WHERE o.batch_id < 2 AND o.zone_id IN ({x.KNOWN_ZONES})
    AND o.zone_id <> '{LATE_ZONE}' AND o.badge_id = s.badge_id
    AND o.event_timestamp = s.event_timestamp))""")
def _(t):
    """Every event is staged; the zone appears before the third batch, which loads all."""
    warehouse = new_warehouse(t, "late-zones")
    zones = t.zones.coalesce(1)
    warehouse.replace_zones(zones.filter(F.col("zone_id") != LATE_ZONE))
    for batch_id, batch in batches(t, SLICE, len(SLICES)):
        if batch_id == 2:
            warehouse.replace_zones(zones)
        ingest.run_batch(warehouse, batch, batch_id, LOAD_TIME)
    return described(warehouse).select(
        "badge_id", "event_timestamp", "user_id", "zone_id", "signal_strength")


@query("inc07_unknown_users", f"""
SELECT DISTINCT user_id, 'UNKNOWN' AS user_name, 'UNKNOWN' AS user_type,
  'UNKNOWN' AS department, 'PUBLIC' AS clearance_level, TRUE AS is_active,
  TRUE AS is_current, {x.stamp(LOAD_TIME)} AS effective_start_date
FROM stg_events WHERE user_id NOT IN (SELECT user_id FROM seed_users)""")
def _(t):
    rows = dims.new_user_rows(t.stg, t.seeded_users, LOAD_TIME, start=6, partitions=8)
    return rows.select(
        "user_id", "user_name", "user_type", "department", "clearance_level", "is_active",
        "is_current", "effective_start_date")


@query("inc08_surrogate_keys", """
SELECT count(*) AS rows, count(*) AS keys, cast(1001 AS bigint) AS first_key,
  1000 + count(*) AS last_key FROM
  (SELECT DISTINCT badge_id, event_timestamp FROM raw_events)""")
def _(t):
    ids = t.raw.select(*selection.EVENT_KEY).distinct()
    return _key_range(dims.dense_keys(ids, "event_key", 1001, selection.EVENT_KEY, 8))


def _key_range(keyed):
    return keyed.agg(
        F.count("*").alias("rows"), F.countDistinct("event_key").alias("keys"),
        F.min("event_key").alias("first_key"), F.max("event_key").alias("last_key"))


@query("inc08_fact_keys", f"""
SELECT count(*) AS rows, count(*) AS keys, cast(1 AS bigint) AS first_key,
  count(*) AS last_key FROM {SLICE_FACTS}""")
def _(t):
    return _key_range(run_slices(t, "fact-keys", replay=True).facts)


@query("inc09_load_times", f"""
SELECT 'staging' AS layer, {x.stamp(LOAD_TIME)} AS load_time, count(*) AS rows
FROM {LATEST} UNION ALL
SELECT 'facts', {x.stamp(LOAD_TIME)}, count(*) FROM {LATEST} JOIN dim_zones USING (zone_id)""")
def _(t):
    warehouse = new_warehouse(t, "load-times")
    ingest.run_batch(warehouse, t.raw, 0, LOAD_TIME)
    layers = (("staging", warehouse.stg, "staging_time"),
              ("facts", warehouse.facts, "fact_load_time"))
    counted = [
        df.groupBy(F.col(column).alias("load_time")).agg(F.count("*").alias("rows"))
        .withColumn("layer", F.lit(layer)) for layer, df, column in layers]
    return counted[0].unionByName(counted[1])


@query("inc10_late_data", f"""
SELECT event_date, count(*) AS events FROM (
  SELECT cast(event_timestamp AS date) AS event_date FROM {SLICE_FACTS}) GROUP BY 1""")
def _(t):
    warehouse = new_warehouse(t, "late-data")
    for batch_id, batch in reversed(batches(t, SLICE, len(SLICES))):  # newest first: the older batches are late
        ingest.run_batch(warehouse, batch, batch_id, LOAD_TIME)
    return warehouse.facts.groupBy("event_date").agg(F.count("*").alias("events"))


@query("inc11_run_log", f"""
SELECT file_name, status, row_count, error_count FROM (
  SELECT concat('batch-', batch_id) AS file_name, 'LOADED' AS status, count(*) AS row_count,
    cast(0 AS bigint) AS error_count FROM {BY_SLICE} GROUP BY batch_id)""")
def _(t):
    log = reports.batch_loads(run_slices(t, "run-log").batch_log)
    recent = reports.load_history(log, ingest.utc_now())
    return recent.select("file_name", "status", "row_count", "error_count")


HOURLY = f"""SELECT date_trunc('hour', ingestion_time)::timestamp AS ingestion_hour,
  count(*) AS event_count, cast(sum(signal_strength) AS decimal(15,2)) AS signal_sum,
  {x.total("CASE WHEN signal_quality = 'WEAK' THEN 1 ELSE 0 END")} AS weak_signal_count,
  {x.total("CASE WHEN direction = 'ENTRY' THEN 1 ELSE 0 END")} AS entry_count,
  {x.total("CASE WHEN direction = 'EXIT' THEN 1 ELSE 0 END")} AS exit_count
FROM raw_events GROUP BY 1"""


@query("inc12_hourly_stream", HOURLY)
def _(t):
    live = Feeds(t.spark, t.sf_dir)
    live.badge_feed = badge_feed(t.stream("events"))
    path = scratch_dir(t.spark, "hourly")
    ingest.start_hourly_metrics(
        live.raw, f"{path}/hours", f"{path}/ckpt", ONCE
    ).awaitTermination()
    return ingest.read_hourly_metrics(t.spark, f"{path}/hours")


@query("inc12_hourly_batch", HOURLY)
def _(t):
    return ingest.hourly_metrics(t.raw)


@query("inc13_enrichment_procedure", f"""
SELECT user_id, zone_id, count(*) AS facts FROM {LATEST}
WHERE zone_id IN ({x.KNOWN_ZONES}) GROUP BY 1, 2""")
def _(t):
    warehouse = new_warehouse(t, "procedure")
    staged = facts.stage_batch(t.raw)
    warehouse.write_staging(staged.withColumn("staging_time", ntz(LOAD_TIME)), 0)
    for _attempt in range(2):  # the second call finds nothing left to load
        ingest.process_badge_events(warehouse, LOAD_TIME)
    return described(warehouse).groupBy("user_id", "zone_id").agg(
        F.count("*").alias("facts"))


# --- a warehouse of many batches ---------------------------------------------------------

SPANS = 6  # batches of five days of ingestion each
SPAN = "least(cast(floor((day(ingestion_time) - 1) / 5) AS int), 5)"
BY_SPAN = f"""(SELECT * FROM (SELECT *, {SPAN} AS batch_id FROM raw_events)
  QUALIFY row_number() OVER (PARTITION BY batch_id, badge_id, event_timestamp
    ORDER BY ingestion_time DESC, seq DESC) = 1)"""
SPAN_FACTS = f"""(SELECT * FROM {BY_SPAN} WHERE zone_id IN ({x.KNOWN_ZONES})
  QUALIFY row_number() OVER (PARTITION BY badge_id, event_timestamp ORDER BY batch_id) = 1)"""


def run_spans(t, purpose: str, options=ingest.LoadOptions()):
    """Every event landed and loaded in six batches, the landing ahead of the load as with two streams."""
    warehouse, spans = new_warehouse(t, purpose), batches(t, SPAN, SPANS)
    with ThreadPoolExecutor(1) as landing:
        landed = [
            landing.submit(warehouse.land, batch.withColumn("reject_reason", F.lit("")), i)
            for i, batch in spans]
        for (batch_id, batch), done in zip(spans, landed):
            done.result()
            ingest.run_batch(warehouse, batch, batch_id, LOAD_TIME, options)
    return warehouse


@query("src14_merged_staging", f"""
SELECT cast(batch_id AS bigint) AS batch_id, count(*) AS staged,
  count(DISTINCT badge_id) AS badges FROM {BY_SPAN} GROUP BY 1""")
def _(t):
    """Small files are merged after every second batch."""
    warehouse = run_spans(t, "merged-staging", ingest.LoadOptions(compact_every=2))
    return warehouse.stg.groupBy("batch_id").agg(
        F.count("*").alias("staged"), F.countDistinct("badge_id").alias("badges"))


@query("src15_merged_facts", f"""
SELECT badge_id, event_timestamp, user_id, zone_id, signal_strength, direction FROM {SPAN_FACTS}""")
def _(t):
    warehouse = run_spans(t, "merged-facts", ingest.LoadOptions(compact_every=2))
    warehouse.compact()
    return described(warehouse).select(
        "badge_id", "event_timestamp", "user_id", "zone_id", "signal_strength", "direction")


@query("src12_merged_landing", f"""
SELECT zone_id, signal_quality, count(*) AS events, max(ingestion_time) AS newest
FROM raw_events GROUP BY 1, 2""")
def _(t):
    warehouse = run_spans(t, "merged-landing")
    for name in warehouse.files.names(warehouse.path("changes")):  # as the load does
        warehouse.files.delete(warehouse.path(f"changes/{name}"))
    warehouse.compact()
    return warehouse.raw.groupBy("zone_id", "signal_quality").agg(
        F.count("*").alias("events"), F.max("ingestion_time").alias("newest"))


@query("inc11_merged_log", f"""
SELECT 'raw_to_staging_task' AS name, cast(batch_id AS bigint) AS batch_id, 'SUCCEEDED' AS state,
  count(*) AS rows_processed FROM {BY_SPAN} GROUP BY batch_id
UNION ALL SELECT 'staging_to_analytics_task', cast(batch_id AS bigint), 'SUCCEEDED', count(*)
FROM {SPAN_FACTS} GROUP BY batch_id""")
def _(t):
    warehouse = run_spans(t, "merged-log", ingest.LoadOptions(compact_every=3))
    return warehouse.batch_log.select("name", "batch_id", "state", "rows_processed")


CHANGES = (("2024-01-10", "A"), ("2024-01-20", "B"))


@query("x03_version_at_the_event", f"""
SELECT s.user_id, count(*) AS events, CASE WHEN u.user_id IS NULL THEN 'UNKNOWN'
  WHEN event_timestamp < TIMESTAMP '2024-01-10' THEN u.department
  WHEN event_timestamp < TIMESTAMP '2024-01-20' THEN concat('A-', s.user_id)
  ELSE concat('B-', s.user_id) END AS department
FROM {ONE_BATCH} s LEFT JOIN seed_users u ON s.user_id = u.user_id
WHERE zone_id IN ({x.KNOWN_ZONES}) GROUP BY 1, 3""")
def _(t):
    """All known users change department twice; an event counts for the one of its time."""
    warehouse = new_warehouse(t, "versions")
    for day, prefix in CHANGES:
        users = warehouse.users
        updates = dims.current(users).withColumn(
            "department", F.concat_ws("-", F.lit(prefix), "user_id"))
        start = dims.next_key(users, "user_key")
        warehouse.replace_users(
            dims.scd2_apply(users, updates, datetime.fromisoformat(day), start))
    events = t.raw.drop("seq")
    ingest.run_batch(
        warehouse, events.withColumn("ingestion_time", ntz(LOAD_TIME)), 0, LOAD_TIME,
        ingest.LoadOptions(user_version="event"))
    keys = warehouse.users.select("user_key", "user_id", "department")
    return warehouse.facts.join(keys, "user_key").groupBy("user_id", "department").agg(
        F.count("*").alias("events"))
