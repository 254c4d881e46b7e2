"""The warehouse tables: layout on shared storage, creation, scans and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelog import schemas
from gatelog.functions.times import ntz
from gatelog.operators.dims import next_key
from gatelog.session import together
from gatelog.sources.days import DayTable, Files, VersionTable
from gatelog.sources.events import TOKEN, Retries, first_sends, rejected
from gatelog.sources.seeds import empty_readers, local_table, seed_users, seed_zones

LANDING = T.StructType(
    [
        *schemas.RAW.fields,
        T.StructField("reject_reason", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)
STAGING = T.StructType(
    [
        *schemas.STAGING.fields,
        T.StructField("batch_id", T.LongType()),
        T.StructField("staging_date", T.DateType()),
    ]
)
FACTS = T.StructType(
    [*schemas.FACTS.fields, T.StructField("fact_load_date", T.DateType())]
)
LOG = T.StructType(
    [*schemas.BATCH_LOG.fields, T.StructField("scheduled_date", T.DateType())]
)
TOTALS = T.StructType([*schemas.TOTALS.fields, T.StructField("load_date", T.DateType())])
WAITING = T.StructType([*schemas.STAGING.fields, T.StructField("zone_bucket", T.IntegerType())])
TOKENS = T.StructType(
    [
        T.StructField(TOKEN, T.StringType()),
        T.StructField("arrival_time", T.TimestampNTZType()),
        T.StructField("arrival_date", T.DateType()),
    ]
)
ZONE_IDS = T.StructType([T.StructField("zone_id", T.StringType())])
#: Folders that waiting rows are spread over by their zone.
ZONE_BUCKETS = 64


# Bloom filters let a lookup of one badge skip row groups where min/max cannot.
BADGE_LOOKUP = {
    "parquet.bloom.filter.enabled#badge_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


RAW_TABLE = "RAW_BADGE_EVENTS"
CREDITS_PER_GB = 0.06  # the published ingest rate


def ingest_credits(size: Column) -> Column:
    return (size / F.lit(float(1 << 30)) * F.lit(CREDITS_PER_GB)).cast(schemas.CREDITS)


def landing_rows(classified: DataFrame) -> DataFrame:
    """Classified events with the landing table's partition columns."""
    return classified.withColumns(
        {
            "accepted": F.col("reject_reason") == "",
            "ingestion_date": F.to_date("ingestion_time"),
        }
    )


def run_name(batch_id: int) -> str:
    """A batch's part in each table."""
    return f"b{batch_id:012d}"


def call_name(call: int) -> str:
    """The part of a load that is not tied to a batch."""
    return f"c{call:012d}"


class Warehouse:
    """Parquet tables below one root path.

    Tables that grow are kept in daily folders with a part per batch (``DayTable``), so a batch writes,
    and a replayed batch overwrites, folders of its own; ``compact`` merges them. ``landing`` holds
    accepted and rejected lines by ingestion date; ``raw`` and ``quarantine`` read one side each.
    ``stg`` is kept by staging date, ``facts`` by event date and below that by load date, the log by
    the day a run was due. Lookbacks on load times prune by these dates. Staged rows whose zone is not
    known wait by zone. ``totals`` holds what each load added to landing and facts, ``tokens`` the
    producers' tokens by arrival if landing tells resent lines.
    Dimensions are replaced as a whole (``VersionTable``).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        days, versions = partial(DayTable, spark, self.root), partial(VersionTable, spark, self.root)
        self.day_tables = {
            "landing": days("landing", LANDING, "ingestion_date", ("accepted",)),
            "stg": days("stg", STAGING, "staging_date"),
            "facts": days("facts", FACTS, "event_date", ("fact_load_date",)),
            "batch_log": days("batch_log", LOG, "scheduled_date"),
            "totals": days("totals", TOTALS, "load_date"),
            "waiting": days("waiting", WAITING, "zone_bucket"),
            "tokens": days("tokens", TOKENS, "arrival_date"),
        }
        self.version_tables = {
            "users": versions("users", schemas.USERS),
            "zones": versions("zones", schemas.ZONES),
            "applied_zones": versions("applied_zones", ZONE_IDS),
        }

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def days(self, name: str) -> DataFrame:
        return self.day_tables[name].read()

    def newest(self, name: str, n: int, wanted: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """Rows of the newest days that hold ``n`` wanted rows, of ``raw``, ``stg``, ``facts`` or ``tasks``."""
        if name == "raw":
            return self.day_tables["landing"].newest(n, lambda df: wanted(_accepted(df)))
        return self.day_tables["batch_log" if name == "tasks" else name].newest(n, wanted)

    @property
    def raw(self) -> DataFrame:
        return _accepted(self.days("landing"))

    @property
    def quarantine(self) -> DataFrame:
        return rejected(self.days("landing").filter("NOT accepted"))

    @property
    def stg(self) -> DataFrame:
        return self.days("stg")

    @property
    def facts(self) -> DataFrame:
        return self.days("facts")

    @property
    def totals(self) -> DataFrame:
        """What each load added to ``RAW`` and ``ANALYTICS``: no scan of the events is needed for their totals."""
        return self.days("totals")

    @property
    def users(self) -> DataFrame:
        return self.version_tables["users"].read()

    @property
    def zones(self) -> DataFrame:
        return self.version_tables["zones"].read()

    @property
    def readers(self) -> DataFrame:
        return self.read("readers", schemas.READERS)

    @property
    def batch_log(self) -> DataFrame:
        return self.days("batch_log")

    @property
    def tasks(self) -> DataFrame:
        return self.batch_log

    @property
    def landing(self) -> DataFrame:
        """Accepted and rejected lines alike."""
        return self.days("landing")

    @property
    def _received(self) -> DataFrame:
        return self.batch_log.filter(F.col("rows_received") > 0)

    @property
    def migration(self) -> DataFrame:
        """What each batch took in, from the log: no scan of the events."""
        return self._received.select(
            F.lit(RAW_TABLE).alias("table_name"),
            F.col("completed_time").alias("end_time"),
            F.col("rows_received").alias("num_rows_migrated"),
            F.col("bytes_processed").alias("num_bytes_migrated"),
            ingest_credits(F.col("bytes_processed")).alias("credits_used"),
        )

    @property
    def clients(self) -> DataFrame:
        """A session per batch; the batch's step is the client."""
        return self._received.select(
            F.col("name").alias("client_name"),
            F.col("scheduled_time").alias("start_time"),
            F.col("completed_time").alias("end_time"),
            ingest_credits(F.col("bytes_processed")).alias("credits_used"),
            F.col("bytes_processed").alias("data_sent_bytes"),
            F.col("rows_received").alias("rows_sent"),
        )

    @property
    def pruning(self) -> DataFrame:
        return self.read("pruning", schemas.PRUNING)

    @property
    def metering(self) -> DataFrame:
        return self.read("metering", schemas.METERING)

    @property
    def storage(self) -> DataFrame:
        return self.read("storage", schemas.STORAGE)

    @property
    def queries(self) -> DataFrame:
        return self.read("queries", schemas.QUERIES)

    def create(self, load_ts: datetime) -> Warehouse:
        """Empty tables and seeded dimensions, replacing what is at the root."""
        for folder in ("keys", "changes", "loaded", "aside", "applied"):
            self.files.delete(self.path(folder))
        for table in self.day_tables.values():
            table.create()
        zones = seed_zones(self.spark, load_ts).coalesce(1)
        first = {
            "users": seed_users(self.spark, load_ts).coalesce(1), "zones": zones,
            "applied_zones": zones.select("zone_id"),
        }
        empty = {"readers": empty_readers(self.spark)} | {
            name: self.spark.createDataFrame([], schema) for name, schema in schemas.TELEMETRY.items()}
        together(
            self.spark,
            [partial(self.version_tables[name].create, rows) for name, rows in first.items()]
            + [partial(rows.write.mode("overwrite").parquet, self.path(name)) for name, rows in empty.items()])
        self.files.mark(self._applied(1))
        self.files.folder(self.path("changes"))
        return self

    def without_resent(self, classified: DataFrame, run: str, retries: Retries) -> DataFrame:
        """A batch's lines but for those resent, by the tokens of earlier batches and its own.

        The tokens are kept by the day they arrived, a part per batch, so only the days within ``delay``
        are listed, and of those files only the tokens that arrived within it are read. A replayed batch
        does not look at its own part.
        """
        table, found = self.day_tables["tokens"], Observation()
        tagged = retries.tokens(classified)
        own = tagged.filter(F.col(TOKEN).isNotNull()).select(TOKEN, F.col("ingestion_time").alias("arrival_time")).distinct()
        arrived = own.withColumn("arrival_date", F.to_date("arrival_time")).observe(
            found, F.min("arrival_time").alias("first"), F.max("arrival_time").alias("last"))
        table.replace(arrived, run)
        first, last = found.get["first"], found.get["last"]
        if first is None:
            return classified
        oldest = first - retries.delay
        earlier = table.read_days(_days(oldest.date(), last.date()), without=run)
        earlier = earlier.filter(F.col("arrival_time") >= ntz(oldest)).select(
            F.col(TOKEN).alias("_seen"), F.col("arrival_time").alias("_at"))
        once = first_sends(tagged, TOKEN, "ingestion_time", retries.delay)
        gap = F.make_dt_interval(secs=F.lit(retries.delay.total_seconds()).cast("decimal(18,6)"))
        resent = (F.col(TOKEN) == F.col("_seen")) & (F.col("ingestion_time") <= F.col("_at") + gap)
        return once.join(earlier, resent, "left_anti").drop(TOKEN)

    def land(self, classified: DataFrame, batch_id: int, retries: Retries | None = None) -> None:
        """One batch of classified lines, in place of what an earlier attempt left; then the word to the load.

        The rows of a batch share their ingestion time, which a replayed batch keeps. With ``retries``
        resent lines are left out.
        """
        run, table, found = run_name(batch_id), self.day_tables["landing"], Observation()
        fine = F.col("reject_reason") == ""
        if retries:
            classified = self.without_resent(classified, run, retries)
        rows = classified.observe(
            found,
            F.min("ingestion_time").alias("first"),
            F.max("ingestion_time").alias("last"),
            F.count_if(fine).alias("n"),
            F.max(F.when(fine, F.col("event_timestamp"))).alias("newest"),
        )
        table.replace(landing_rows(rows), run, **BADGE_LOOKUP)
        seen = found.get
        if seen["first"] is None:
            return
        if seen["first"] == seen["last"]:
            row = {"load_time": seen["first"], "row_count": seen["n"], "newest_event": seen["newest"]}
            added = local_table(self.spark, [{"layer": "RAW", **row}], schemas.TOTALS).coalesce(1)
        else:
            days = _days(seen["first"].date(), seen["last"].date())
            added = added_rows(_accepted(table.read_days(days, run)), "RAW", "ingestion_time").hint("rebalance")
        self._add_totals(added, run.replace("b", "r"))
        change = f"{run}@{seen['first'].date()}@{seen['last'].date()}"
        self.files.mark(self.path(f"changes/{change}"), again=True, text=f"{change}\n")

    def landed(self, changes: list[str]) -> DataFrame:
        """The accepted rows of landed batches, by their names in the change feed."""
        table, paths = self.day_tables["landing"], []
        for run, first, last in (c.split("@") for c in changes):
            for day in _days(date.fromisoformat(first), date.fromisoformat(last)):
                folder = f"{table.path}/ingestion_date={day}/part={run}"
                paths += [folder] if first == last or self.files.names(folder) else []
        return table._of(paths).filter("accepted").select(*schemas.RAW.names)

    def _add_totals(self, added: DataFrame, run: str) -> None:
        dated = added.withColumn("load_date", F.to_date("load_time"))
        self.day_tables["totals"].replace(dated, run)

    def log(self, entry: DataFrame, run: str) -> None:
        dated = entry.withColumn("scheduled_date", F.to_date("scheduled_time"))
        self.day_tables["batch_log"].append(dated.coalesce(1), run)

    def write_staging(self, staged: DataFrame, batch_id: int) -> None:
        """Replace this batch's part; a replay leaves one copy, on whatever day it runs."""
        table, run = self.day_tables["stg"], run_name(batch_id)
        table.remove(run)
        stamped = staged.select(*schemas.STAGING.names).withColumns(
            {"batch_id": F.lit(batch_id).cast("bigint"), "staging_date": F.to_date("staging_time")}
        )
        table.replace(stamped, run)

    def staged_in(self, batch_id: int) -> DataFrame:
        """One batch, by its own folder: the cost does not grow with earlier batches."""
        return self.day_tables["stg"].run(run_name(batch_id)).drop("batch_id", "staging_date")

    def facts_on(self, dates: Iterable[date]) -> DataFrame:
        """The facts of some event dates; only their folders are listed."""
        return self.day_tables["facts"].read_days(dates)

    def fact_dates(self, dates: Iterable[date]) -> list[date]:
        """Which of these event dates have a folder of facts."""
        table = self.day_tables["facts"]
        days = set(table.days())
        return [d for d in dates if f"{table.day}={d}" in days]

    def append_facts(self, facts: DataFrame, run: str = run_name(0)) -> None:
        """Append by event and load date. Use ``cluster_by_date`` first to size the files."""
        dated = facts.withColumn("fact_load_date", F.to_date("fact_load_time"))
        self.day_tables["facts"].append(dated, run, **BADGE_LOOKUP)

    def add_fact_totals(self, dates: Iterable[date], run: str) -> None:
        """What a run's facts, of all its attempts, added to the table."""
        own = self.day_tables["facts"].read_days(dates, run)
        self._add_totals(added_rows(own, "ANALYTICS", "fact_load_time").coalesce(1), run)

    def replace_zones(self, zones: DataFrame) -> None:
        """Zones are type 1: one row each, the whole table written anew as its next version."""
        self.version_tables["zones"].replace(zones)

    def replace_users(self, users: DataFrame) -> None:
        """The user dimension's next version, such as the result of ``scd2_apply``; later keys follow its largest."""
        self.version_tables["users"].replace(users)
        last = next_key(self.users, "user_key") - 1
        reserved = self.files.names(self.path("keys/users"))
        if not reserved or int(reserved[-1]) < last:
            self.files.mark(self.path(f"keys/users/{last:019d}"))

    def add_users(self, rows: DataFrame) -> None:
        self.version_tables["users"].append(rows)

    def compact(self) -> int:
        """Merge the small files of all tables but those of the newest runs; readers and loads go on.

        Leave between two calls the time that the longest reader takes. Landed batches that the load has
        not taken yet keep their parts. Returns how many parts went into others.
        """
        waiting = self.files.names(self.path("changes"))
        before = {"landing": waiting[0].split("@")[0]} if waiting else {}
        merges = [partial(t.merge, before=before.get(name)) for name, t in self.day_tables.items()]
        return sum(together(self.spark, merges))

    def aside(self, name: str, df: DataFrame) -> DataFrame:
        """Rows written next to the tables by the one load that runs, and read back."""
        path = self.path(f"aside/{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def reserve_keys(self, table: str, key: str, count: int) -> int:
        """The first of ``count`` keys that no other call gets.

        The last reserved key is the name of an empty file; the one before it is kept, so
        the folder holds two. A table without such a file is asked for its largest key,
        once. Tables have one writer at a time. On file systems whose create fails if the file is there,
        a second writer fails or takes later keys; object stores without it give no such guard.
        """
        folder = self.path(f"keys/{table}")
        reserved = self.files.names(folder)
        last = int(reserved[-1]) if reserved else next_key(getattr(self, table), key) - 1
        self.files.mark(f"{folder}/{last + count:019d}")
        for old in reserved[:-1]:
            self.files.delete(f"{folder}/{old}")
        return last + 1

    def next_call(self) -> str:
        """The part name of a load that is not tied to a batch."""
        folder = self.path("keys/calls")
        names = self.files.names(folder)
        call = int((names or ["-1"])[-1]) + 1
        self.files.mark(f"{folder}/{call:019d}")
        for old in names[:-1]:
            self.files.delete(f"{folder}/{old}")
        return call_name(call)

    def write_waiting(self, staged: DataFrame, run: str) -> None:
        """Add the rows whose zone is not known to those that wait, in folders by zone."""
        unknown = staged.join(self.zones.select("zone_id"), "zone_id", "left_anti")
        bucket = F.pmod(F.xxhash64("zone_id"), F.lit(ZONE_BUCKETS)).cast("int")
        rows = unknown.select(*schemas.STAGING.names, bucket.alias("zone_bucket"))
        self.day_tables["waiting"].replace(rows, run)

    def _applied(self, version: int) -> str:
        return self.path(f"applied/{version:09d}")

    def new_zones(self) -> tuple[int, DataFrame | None]:
        """The zone table's version, and the ids that the last load did not know; None if it is the same version.

        Two sets of zone ids are compared, and only after a change of the zone table.
        """
        version = self.version_tables["zones"].version
        if self.files.names(self.path("applied"))[-1:] == [f"{version:09d}"]:
            return version, None
        known = self.version_tables["applied_zones"].read()
        ids = self.version_tables["zones"].read(version).select("zone_id").distinct()
        return version, ids.join(known, "zone_id", "left_anti")

    def freed(self, zones: DataFrame) -> DataFrame:
        """Waiting rows of these zones: only their folders are read."""
        bucket = F.pmod(F.xxhash64("zone_id"), F.lit(ZONE_BUCKETS)).cast("int")
        buckets = [r[0] for r in zones.select(bucket.alias("b")).distinct().collect()]
        waiting = self.day_tables["waiting"].read_days(buckets).drop("zone_bucket")
        return waiting.join(zones, "zone_id", "left_semi").select(*schemas.STAGING.names)

    def zones_applied(self, version: int) -> None:
        """Remember the ids of a zone version whose waiting rows are loaded. A zone that is removed waits again."""
        zones = self.version_tables["zones"].read(version).select("zone_id").distinct()
        self.version_tables["applied_zones"].replace(zones)
        self.files.mark(self._applied(version), again=True)
        for old in self.files.names(self.path("applied"))[:-1]:
            self.files.delete(self.path(f"applied/{old}"))

    def mark_loaded(self, batch_id: int) -> None:
        """All staged batches up to this one have their facts."""
        folder = self.path("loaded")
        names = self.files.names(folder)
        self.files.mark(f"{folder}/{run_name(batch_id)}", again=True)
        for old in names[:-1]:
            self.files.delete(f"{folder}/{old}")

    def not_loaded(self) -> tuple[DataFrame | None, int]:
        """Staged rows of batches after the last loaded one (None if there is none), and the newest batch."""
        names = self.files.names(self.path("loaded"))
        last = int(names[-1][1:]) if names else -1
        rows = self.day_tables["stg"].runs_after(run_name(last) if names else "b")
        if rows is None:
            return None, last
        later = rows.filter(F.col("batch_id") > last)
        newest = int(self.day_tables["stg"].newest_run("b")[1:])
        return later.drop("batch_id", "staging_date"), newest

    def write_run_metadata(self, account: str, expires: date, now: datetime) -> None:
        """One row, replaced on each deployment."""
        row = {
            "deployment_timestamp": now, "account_identifier": account, "expires_date": expires,
        }
        table = local_table(self.spark, [row], schemas.RUN_METADATA)
        table.coalesce(1).write.mode("overwrite").parquet(self.path("run_metadata"))

    @property
    def run_metadata(self) -> DataFrame:
        return self.read("run_metadata", schemas.RUN_METADATA)


def _accepted(landing: DataFrame) -> DataFrame:
    return landing.filter("accepted").select(*schemas.RAW.names, "ingestion_date")


def added_rows(rows: DataFrame, layer: str, column: str) -> DataFrame:
    """Rows and newest event per load time of one layer, as in ``totals``."""
    return rows.groupBy(F.col(column).alias("load_time")).agg(
        F.lit(layer).alias("layer"),
        F.count("*").alias("row_count"),
        F.max("event_timestamp").alias("newest_event"),
    ).select(*schemas.TOTALS.names)


def _days(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def cluster_by_date(df: DataFrame) -> DataFrame:
    """Group rows by event date and order them by time inside each task.

    Rebalancing splits a date that holds most of the batch over several tasks and
    merges small dates, by size.
    """
    return df.hint("rebalance", "event_date").sortWithinPartitions(
        "event_date", "event_timestamp"
    )

