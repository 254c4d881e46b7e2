"""The warehouse tables derived from the supplied test tables.

Badge events come from ``events``; telemetry comes from ``orders``, ``lineitem`` and
``part``. Every row of the source tables is used.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelog import schemas
from gatelog.functions.labels import signal_quality
from gatelog.operators.dims import upsert_unknown_users
from gatelog.operators.facts import enrich
from gatelog.operators.selection import EVENT_KEY, first_per_key, newest_copy
from gatelog.session import configure
from gatelog.sources.seeds import USER_ROWS, ZONE_ROWS, empty_readers, seed_users, seed_zones
from gatelog.sources.tables import added_rows

# Fixed times that fall inside the supplied data.
AS_OF = datetime(2024, 1, 31, 0, 5)
AS_OF_TODAY = datetime(2024, 1, 30, 23, 59, 59)
AS_OF_TASKS = datetime(2001, 8, 1)
AS_OF_PRUNE = datetime(2001, 11, 4)
SEED_TIME = datetime(2024, 1, 1)
LOAD_TIME = datetime(2024, 1, 31)

DEMO_DATABASE = "DEMO"


def plus_seconds(column: Column, seconds: Column | int) -> Column:
    amount = F.lit(seconds) if isinstance(seconds, int) else seconds
    return column + F.make_dt_interval(secs=amount.cast("decimal(18,6)"))


def truncated(unit: str, column: str) -> Column:
    return F.date_trunc(unit, F.col(column).cast("timestamp")).cast("timestamp_ntz")


class Feeds:
    """Tables over one data directory, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream; the pattern also matches a directory of files."""
        schema = self.source(name).schema
        reader = self.spark.readStream.schema(schema)
        return reader.parquet(f"{self.sf_dir}/{name}.parque[t]")

    @cached_property
    def badge_feed(self) -> DataFrame:
        return badge_feed(self.source("events"))

    @cached_property
    def raw(self) -> DataFrame:
        whole = F.col("signal_in").cast("decimal(38,0)")
        return self.badge_feed.select(
            "seq", *schemas.REQUIRED,
            F.coalesce(whole, F.lit(-999)).cast(schemas.SIGNAL).alias("signal_strength"),
            signal_quality(whole).alias("signal_quality"),
            F.upper("direction_in").alias("direction"),
            "ingestion_time",
            F.col("extra_json").alias("raw_json"),
        )

    @cached_property
    def stg(self) -> DataFrame:
        """Staging after one batch per ingestion day."""
        daily = self.raw.withColumn("batch_date", F.to_date("ingestion_time"))
        kept = first_per_key(daily, ("batch_date", *EVENT_KEY), newest_copy(daily))
        return kept.drop("raw_json").withColumn(
            "staging_time", plus_seconds(F.col("ingestion_time"), 60)
        )

    @cached_property
    def zones(self) -> DataFrame:
        return seed_zones(self.spark, SEED_TIME)

    @cached_property
    def seeded_users(self) -> DataFrame:
        return seed_users(self.spark, SEED_TIME)

    @cached_property
    def users(self) -> DataFrame:
        """Seeded users and those created from the events."""
        start = len(USER_ROWS) + 1
        return upsert_unknown_users(self.raw, self.seeded_users, LOAD_TIME, start)

    @cached_property
    def readers(self) -> DataFrame:
        return empty_readers(self.spark)

    @cached_property
    def facts(self) -> DataFrame:
        """Facts after loading the daily batches in order: the first copy of a key stays."""
        enriched = enrich(self.stg, self.users, self.zones)
        first = first_per_key(enriched, EVENT_KEY, [F.col("batch_date").asc()])
        return first.withColumn("fact_load_time", plus_seconds(F.col("ingestion_time"), 120))

    @cached_property
    def migration(self) -> DataFrame:
        return self.raw.groupBy(truncated("hour", "ingestion_time"), F.col("seq") % 4).agg(
            F.lit("RAW_BADGE_EVENTS").alias("table_name"),
            F.max("ingestion_time").alias("end_time"),
            F.count("*").alias("num_rows_migrated"),
            F.sum(F.length("raw_json") + 500).alias("num_bytes_migrated"),
            micro_credits(),
        ).select(
            "table_name", "end_time", "num_rows_migrated", "num_bytes_migrated", "credits_used"
        )

    @cached_property
    def clients(self) -> DataFrame:
        client = F.concat(F.lit("client-"), (F.col("seq") % 3).cast("string"))
        return self.raw.groupBy(
            client.alias("client_name"), truncated("hour", "ingestion_time").alias("_hour")
        ).agg(
            F.min("ingestion_time").alias("start_time"),
            F.max("ingestion_time").alias("end_time"),
            micro_credits(),
            F.sum(F.length("raw_json") + 500).alias("data_sent_bytes"),
            F.count("*").alias("rows_sent"),
        ).drop("_hour")

    @cached_property
    def tasks(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        failed = status == "O"
        return self.source("orders").select(
            F.when(F.col("o_custkey") % 2 == 0, "raw_to_staging_task")
            .otherwise("staging_to_analytics_task").alias("name"),
            F.lit(DEMO_DATABASE).alias("database_name"),
            F.when(status == "F", "SUCCEEDED").when(failed, "FAILED").otherwise("SKIPPED")
            .alias("state"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("scheduled_time"),
            plus_seconds(F.col("o_orderdate").cast("timestamp_ntz"), key % 40)
            .alias("completed_time"),
            F.when(failed, (1000 + key % 3).cast("string")).alias("error_code"),
            F.when(failed, F.concat(F.lit("error "), (key % 3).cast("string")))
            .alias("error_message"),
            (key % 5).alias("rows_processed"),
            key.alias("run_id"),
        )

    @cached_property
    def pruning(self) -> DataFrame:
        flag, quantity = F.col("l_returnflag"), F.col("l_quantity").cast("bigint")
        pruned = F.col("l_partkey") % 200
        return self.source("lineitem").select(
            F.when(flag == "A", "RAW_BADGE_EVENTS").when(flag == "N", "FCT_ACCESS_EVENTS")
            .otherwise("OTHER").alias("table_name"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("interval_start_time"),
            F.col("l_linenumber").cast("bigint").alias("num_queries"),
            quantity.alias("partitions_scanned"),
            pruned.alias("partitions_pruned"),
            (quantity * 100000).alias("rows_scanned"),
            (pruned * 100000).alias("rows_pruned"),
        )

    @cached_property
    def metering(self) -> DataFrame:
        start = F.col("o_orderdate").cast("timestamp_ntz")
        credits = (F.col("o_orderkey") % 97).cast("decimal(9,2)")
        idle = F.col("o_orderkey") % 7 == 0
        return self.source("orders").select(
            F.lit("COMPUTE_WH").alias("warehouse_name"),
            start.alias("start_time"),
            plus_seconds(start, 3600).alias("end_time"),
            credits.alias("credits_used"),
            F.when(idle, F.lit(0).cast("decimal(9,2)")).otherwise(credits)
            .alias("credits_used_compute"),
        )

    @cached_property
    def storage(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.source("part").select(
            F.lit(DEMO_DATABASE).alias("table_catalog"),
            F.col("p_brand").alias("table_schema"),
            F.col("p_name").alias("table_name"),
            (key * 1000000).alias("active_bytes"),
            (key % 50 * 1000000).alias("time_travel_bytes"),
            (key % 20 * 1000000).alias("failsafe_bytes"),
        )

    @cached_property
    def queries(self) -> DataFrame:
        quantity = F.col("l_quantity").cast("bigint")
        return self.source("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("query_id"),
            F.concat(F.lit("user-"), (F.col("l_suppkey") % 10).cast("string"))
            .alias("user_name"),
            F.lit(DEMO_DATABASE).alias("database_name"),
            F.when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("FAIL")
            .alias("execution_status"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("start_time"),
            F.floor("l_extendedprice").cast("bigint").alias("total_elapsed_ms"),
            (quantity * 100000000).alias("bytes_scanned"),
            quantity.alias("partitions_scanned"),
            (quantity + F.col("l_partkey") % 200).alias("partitions_total"),
            F.concat(F.lit("select "), F.col("l_partkey").cast("string")).alias("query_text"),
            F.concat(F.lit("10.0.0."), (F.col("l_suppkey") % 250).cast("string"))
            .alias("client_ip"),
            F.col("l_linestatus").alias("event_type"),
        )

    @cached_property
    def totals(self) -> DataFrame:
        """What each load time added to raw events and facts."""
        raw = added_rows(self.raw, "RAW", "ingestion_time")
        return raw.unionByName(added_rows(self.facts, "ANALYTICS", "fact_load_time"))

    def newest(self, name: str, n: int, wanted=lambda df: df) -> DataFrame:
        """All wanted rows: the test tables have no daily folders."""
        return wanted(getattr(self, name))

    @cached_property
    def load_log(self) -> DataFrame:
        """One load entry per ingestion hour; rejects are the events of unknown zones."""
        unknown = F.col("zone_id") == "ZONE-UNKNOWN"
        return self.raw.groupBy(truncated("hour", "ingestion_time").alias("_hour")).agg(
            F.lit("RAW_BADGE_EVENTS").alias("table_name"),
            F.date_format(F.max("ingestion_time"), "yyyyMMddHH").alias("file_name"),
            F.max("ingestion_time").alias("last_load_time"),
            F.count("*").alias("row_count"),
            F.count_if(unknown).alias("error_count"),
            F.min(F.when(unknown, F.col("badge_id"))).alias("first_error_message"),
        ).drop("_hour")

    def json_lines(self, feed: DataFrame | None = None) -> DataFrame:
        """The badge feed as the producer sends it: one JSON object per line."""
        return json_lines(self.badge_feed if feed is None else feed)


def micro_credits() -> Column:
    return (F.count("*") * F.expr("0.000001BD")).cast(schemas.CREDITS).alias("credits_used")


def _by_zone(values: list[str], unknown: str) -> Column:
    """Every 20th event is from an unknown zone; the others cycle through the five."""
    event = F.col("event_id")
    known = F.element_at(F.array(*[F.lit(v) for v in values]), (event % 5 + 1).cast("int"))
    return F.when(event % 20 == 19, unknown).otherwise(known)


def badge_feed(events: DataFrame) -> DataFrame:
    """Badge events with producer-side fields; batch or streaming."""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    cents = (F.round(F.col("value") * 100).cast("bigint") % 6000).cast("decimal(9,2)")
    signal = F.lit(-30).cast("decimal(9,2)") - cents * F.expr("0.01BD")
    padded = lambda number, width: F.lpad(number.cast("string"), width, "0")
    return events.select(
        event.alias("seq"),
        F.concat(F.lit("BADGE-"), padded(1 + user, 6)).alias("badge_id"),
        F.concat(F.lit("USR-"), padded(1 + user % 8, 3)).alias("user_id"),
        _by_zone([row[0] for row in ZONE_ROWS], "ZONE-UNKNOWN").alias("zone_id"),
        _by_zone([row[1] for row in ZONE_ROWS], "RDR-UNKNOWN").alias("reader_id"),
        truncated("hour", "ts").alias("event_timestamp"),
        F.when(event % 17 != 0, signal.cast("decimal(9,2)")).alias("signal_in"),
        F.when(kind.isin("click", "signup"), "entry")
        .when(kind.isin("view", "purchase"), "exit").alias("direction_in"),
        plus_seconds(F.col("ts"), event % 120).alias("ingestion_time"),
        F.col("props").alias("extra_json"),
    )


def json_lines(feed: DataFrame) -> DataFrame:
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    payload = F.to_json(
        F.struct(
            "badge_id", "user_id", "zone_id", "reader_id",
            stamp.alias("event_timestamp"),
            F.col("signal_in").alias("signal_strength"),
            F.col("direction_in").alias("direction"),
            F.col("extra_json").alias("extra"),
            "seq",
        )
    )
    return feed.select("seq", payload.alias("value"))
