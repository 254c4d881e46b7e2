"""Streams: landing, change feed, per-batch load, live hourly metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gatelog import schemas
from gatelog.functions.numbers import sum_if
from gatelog.functions.times import ntz
from gatelog.operators.dims import dense_keys, task_counts, unknown_user_ids, user_rows, within_task
from gatelog.operators.facts import (
    drop_faint,
    event_dates,
    fact_columns,
    load_facts,
    stage_batch,
    times_present,
    unstaged,
)
from gatelog.session import together
from gatelog.sources.days import DayTable
from gatelog.sources.events import Retries, classify_events
from gatelog.sources.seeds import local_table
from gatelog.sources.tables import Warehouse, cluster_by_date, run_name

STAGE_TASK = "raw_to_staging_task"
FACT_TASK = "staging_to_analytics_task"
DATABASE = "DEMO"
EVERY_MINUTE = {"processingTime": "1 minute"}
WHOLE_STAGING = -1  # batch id logged by a load that is not tied to one batch


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class LoadOptions:
    """How a batch is staged and enriched; the defaults follow the shipped SQL."""

    dedupe_scope: str = "batch"  # or "table": insert-only merge over all batches
    signal_floor: float | None = None
    keep_missing_signal: bool = True
    dimension_join: str = "inner"  # or "left": keep unknown zones with null keys
    unique_facts: bool = False
    user_version: str = "current"  # or "event": the user row valid at the event's time
    key_partitions: int | None = None  # tasks that number new users
    compact_every: int | None = None  # batches between two merges of small files


def first_batch(checkpoint: str, table: DayTable) -> int:
    """What is added to a stream's batch numbers, so that a new checkpoint goes on where another ended."""
    folder = f"{checkpoint}/first_batch"
    names = table.files.names(folder)
    if names:
        return int(names[0])
    newest = table.newest_run("b")
    first = int(newest[1:]) + 1 if newest else 0
    table.files.mark(f"{folder}/{first}")
    return first


def start_landing(
    lines: DataFrame, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None,
    retries: Retries | None = None,
) -> StreamingQuery:
    """Type JSON lines into the landing table, rejects beside accepted rows, without lines resent if told how.

    One pass: each line is read and parsed once. A batch writes folders of its own and a repeated
    one writes them again, with the stamp of the first attempt, so lines land exactly once; no log grows with
    the files. Then the batch is named to the load.
    """
    first = first_batch(checkpoint, warehouse.day_tables["landing"])

    def land(batch: DataFrame, batch_id: int) -> None:
        warehouse.land(batch, first + batch_id, retries)

    return (
        classify_events(lines)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


#: The column of ``read_changes``.
LANDED = "landed"


def read_changes(warehouse: Warehouse, max_age: str = "30d", **options) -> DataFrame:
    """The change feed of the append-only landing table: the names of landed batches, a file each.

    Files of loaded batches are deleted, so what is listed does not grow with history. A name that waits
    longer than ``max_age`` while others come is not seen any more. ``options`` go to the file source, such
    as maxFilesPerTrigger to bound a backfill.
    """
    kept = {"cleanSource": "delete", "maxFileAge": max_age, **options}
    names = warehouse.spark.readStream.options(**kept).text(warehouse.path("changes"))
    return names.withColumnRenamed("value", LANDED)


def only_inserts(changes: DataFrame, action: str = "_change_type") -> DataFrame:
    """Insert rows of a feed that carries change types; other feeds pass through."""
    if action not in changes.columns:
        return changes
    return changes.filter(F.col(action) == "insert").drop(action)


def log_batch(warehouse: Warehouse, name: str, batch_id: int, state: str, **fields) -> None:
    """Append one run to the batch log, to the day it was due."""
    now, run_id = utc_now(), uuid4().hex
    run = fields.pop("run", None) or run_name(max(batch_id, 0))
    row = {
        "name": name, "database_name": DATABASE, "state": state, "batch_id": batch_id,
        "completed_time": now, "run_id": run_id, **fields,
    }
    entry = local_table(warehouse.spark, [row], schemas.BATCH_LOG)
    warehouse.log(entry, f"{run}-{now:%H%M%S%f}-{run_id}")


def _logged(
    warehouse: Warehouse, name: str, batch_id: int, step: Callable[[], dict],
    run: str | None = None,
) -> dict:
    """Run one step and log its outcome; a failure is logged, then raised again."""
    started = utc_now()
    try:
        result = step()
    except Exception as error:
        log_batch(
            warehouse, name, batch_id, "FAILED", scheduled_time=started, rows_processed=0,
            error_count=1, error_code=type(error).__name__, error_message=str(error), run=run,
        )
        raise
    state = "SUCCEEDED" if result["rows_processed"] else "SKIPPED"
    log_batch(
        warehouse, name, batch_id, state, scheduled_time=started, error_count=0, run=run,
        **result,
    )
    return result


def _stage(
    warehouse: Warehouse, changes: DataFrame, batch_id: int, load_ts: datetime,
    options: LoadOptions,
) -> dict:
    rows = only_inserts(changes)
    if options.signal_floor is not None:
        rows = drop_faint(rows, options.signal_floor, options.keep_missing_signal)
    received, kept = Observation(), Observation()
    size = F.octet_length("raw_json") if "raw_json" in rows.columns else F.lit(0)
    seen = rows.observe(
        received, F.sum(size).cast("bigint").alias("bytes"), F.count("*").alias("rows")
    )
    staged = stage_batch(seen)
    if options.dedupe_scope == "table":
        others = warehouse.day_tables["stg"].read(without=run_name(batch_id))
        staged = unstaged(staged, others.filter(times_present(rows)))
    counted = staged.observe(kept, F.count("*").alias("rows"))
    # Stamped above the count, the time is seen to be one value, and the writer need not sort by its day.
    warehouse.write_staging(counted.withColumn("staging_time", ntz(load_ts)), batch_id)
    return {
        "rows_processed": kept.get["rows"],
        "bytes_processed": received.get["bytes"],
        "rows_received": received.get["rows"],
    }


def create_unknown_users(
    warehouse: Warehouse, staged: DataFrame, load_ts: datetime, partitions: int | None
) -> None:
    """Append a row for each user id without a current one; usually there is none."""
    ids = unknown_user_ids(staged, warehouse.users)
    n = ids.count()
    if n:
        first = warehouse.reserve_keys("users", "user_key", n)
        keyed = dense_keys(ids, "user_key", first, ["user_id"], partitions)
        warehouse.add_users(user_rows(keyed, load_ts))


def append_new_facts(
    warehouse: Warehouse, rows: DataFrame, load_ts: datetime, run: str = run_name(0)
) -> dict:
    """Append facts with the next keys, without gaps; returns rows written and last key.

    The rows are written aside once, so that they can be counted per task before they get
    their keys. The keys are reserved before the facts are written: a lost attempt leaves
    a gap, never a key that is used twice.
    """
    aside = warehouse.aside("facts", rows.withColumn("_row", F.monotonically_increasing_id()))
    counts = task_counts(aside, F.col("_row"))
    n = sum(counts.values())
    if not n:
        return {"rows_processed": 0}
    first = warehouse.reserve_keys("facts", "event_key", n)
    key = F.lit(first) + within_task(counts, F.col("_row"))
    keyed = aside.withColumn("event_key", key).drop("_row")
    facts = fact_columns(cluster_by_date(keyed), F.col("event_key"), load_ts)
    warehouse.append_facts(facts, run)
    return {"rows_processed": n, "max_event_key": first + n - 1}


def _load(
    warehouse: Warehouse, staged: DataFrame, run: str, load_ts: datetime, options: LoadOptions
) -> dict:
    """Facts of staged rows, and of rows that waited for a zone that is new since the last load.

    A batch adds its own rows of unknown zones to those that wait, and reads none of them unless the zone
    table has changed.
    """
    inner, new = options.dimension_join == "inner", None
    steps = [
        partial(event_dates, staged),
        partial(create_unknown_users, warehouse, staged, load_ts, options.key_partitions),
    ]
    dates = together(warehouse.spark, steps + [partial(warehouse.write_waiting, staged, run)] * inner)[0]
    if inner:
        version, new = warehouse.new_zones()
        if new is not None:
            freed = warehouse.freed(new)
            dates = list({*dates, *event_dates(freed)})
            staged = staged.unionByName(freed)
    held = warehouse.fact_dates(dates)
    rows = load_facts(
        staged, warehouse.users, warehouse.zones, warehouse.facts_on(held),
        unique=options.unique_facts, how=options.dimension_join, version=options.user_version,
        held=held,
    )
    result = append_new_facts(warehouse, rows, load_ts, run)
    warehouse.add_fact_totals(dates, run)
    if new is not None:
        warehouse.zones_applied(version)
    return result


def run_batch(
    warehouse: Warehouse,
    changes: DataFrame,
    batch_id: int,
    load_ts: datetime | None = None,
    options: LoadOptions = LoadOptions(),
) -> None:
    """Stage one batch, create its unknown users, append its facts; nothing if it is empty.

    Safe to repeat: staging overwrites its own partition; users and facts are checked
    against what is already stored, so a replay adds only what a lost attempt left out.
    """
    if changes.isEmpty():
        return
    load_ts = load_ts or utc_now()
    staged = _logged(
        warehouse, STAGE_TASK, batch_id,
        lambda: _stage(warehouse, changes, batch_id, load_ts, options),
    )
    if staged["rows_processed"]:
        _logged(
            warehouse, FACT_TASK, batch_id,
            lambda: _load(
                warehouse, warehouse.staged_in(batch_id), run_name(batch_id), load_ts, options),
        )
        warehouse.mark_loaded(batch_id)
    if options.compact_every and batch_id % options.compact_every == options.compact_every - 1:
        warehouse.compact()


def start_load(
    changes: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    options: LoadOptions = LoadOptions(),
) -> StreamingQuery:
    """Run ``run_batch`` for every non-empty micro-batch of the change feed.

    ``changes`` is ``read_changes``, or any stream of raw rows.
    """
    first = first_batch(checkpoint, warehouse.day_tables["stg"])
    named = changes.columns == [LANDED]

    def load(batch: DataFrame, batch_id: int) -> None:
        if named:
            names = sorted(r[LANDED] for r in batch.collect())
            if not names:
                return
            batch = warehouse.landed(names)
        run_batch(warehouse, batch, first + batch_id, options=options)

    return (
        changes.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def process_badge_events(
    warehouse: Warehouse, load_ts: datetime, partitions: int | None = None
) -> dict:
    """Enrich everything staged and not yet loaded, in one call.

    Batches up to the last loaded one are not read; a call without later ones, and without new zones,
    reads nothing. Two staged copies of a key first seen in the same call are both loaded; the
    streaming path never meets that case.
    """
    run, options = warehouse.next_call(), LoadOptions(key_partitions=partitions)

    def load() -> dict:
        staged, newest = warehouse.not_loaded()
        if staged is None:
            if warehouse.new_zones()[1] is None:
                return {"rows_processed": 0}
            staged = warehouse.spark.createDataFrame([], schemas.STAGING)
        result = _load(warehouse, staged, run, load_ts, options)
        warehouse.mark_loaded(newest)
        return result

    loaded = _logged(warehouse, FACT_TASK, WHOLE_STAGING, load, run)
    return {"status": "COMPLETED", "facts_loaded": loaded["rows_processed"]}


def hourly_metrics(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Tumbling one-hour counts over ingestion time, batch or streaming.

    With a watermark, an append sink gets each hour once, when it is closed.
    """
    timed = events.withColumn("_time", F.col("ingestion_time").cast("timestamp"))
    if watermark:
        timed = timed.withWatermark("_time", watermark)
    return (
        timed.groupBy(F.window("_time", "1 hour"))
        .agg(
            F.count("*").alias("event_count"),
            F.sum("signal_strength").alias("signal_sum"),
            sum_if(F.col("signal_quality") == "WEAK").alias("weak_signal_count"),
            sum_if(F.col("direction") == "ENTRY").alias("entry_count"),
            sum_if(F.col("direction") == "EXIT").alias("exit_count"),
        )
        .select(F.col("window.start").cast("timestamp_ntz").alias("ingestion_hour"), "*")
        .drop("window")
    )


PARTIAL_HOURS = T.StructType(
    [
        T.StructField("ingestion_hour", T.TimestampNTZType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("signal_sum", T.DecimalType(15, 2)),
        T.StructField("weak_signal_count", T.LongType()),
        T.StructField("entry_count", T.LongType()),
        T.StructField("exit_count", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)


def hourly_table(spark: SparkSession, path: str) -> DayTable:
    """The partial hours that ``start_hourly_metrics`` writes."""
    root, _, name = path.rstrip("/").rpartition("/")
    return DayTable(spark, root, name, PARTIAL_HOURS, "day")


def start_hourly_metrics(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the hours up to date, whatever arrives late, without state.

    A micro-batch writes its own counts per hour, a few rows in the folders of the days it has events
    of, and a repeated batch writes the same part again. ``read_hourly_metrics`` adds them up;
    ``hourly_table(…).merge()`` puts small parts together.
    """
    table = hourly_table(events.sparkSession, path)
    if not table.files.names(path):
        table.create()
    first = first_batch(checkpoint, table)

    def publish(batch: DataFrame, batch_id: int) -> None:
        hours = hourly_metrics(batch).withColumn("day", F.to_date("ingestion_hour"))
        table.replace(hours.select(*PARTIAL_HOURS.names).coalesce(1), run_name(first + batch_id))

    return (
        events.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def read_hourly_metrics(
    spark: SparkSession, path: str, days: Iterable[date] | None = None
) -> DataFrame:
    """All hours, or those of some days, each once."""
    table = hourly_table(spark, path)
    partial = table.read() if days is None else table.read_days(days)
    counts = [n for n in PARTIAL_HOURS.names if n not in ("ingestion_hour", "day")]
    return partial.groupBy("ingestion_hour").agg(
        *[F.sum(n).cast(PARTIAL_HOURS[n].dataType).alias(n) for n in counts])
