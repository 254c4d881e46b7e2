"""Physical plans: what must hold at a thousand times the data."""

import re
from datetime import timedelta

import pytest
from shared import NOW
from pyspark.sql import functions as F

from gatelog.operators import dims, facts, selection
from gatelog.plans import views
from gatelog.sources.events import validate_events
from gatelog.sources.tables import (
    BADGE_LOOKUP,
    Warehouse,
    cluster_by_date,
)
from gatelog.streaming import ingest


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    lines = re.findall(r"FileScan parquet.*", plan(df))
    return [line for line in lines if f"/{table}]" in line]


@pytest.fixture(autouse=True)
def whole_paths(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def conf(spark):
    changed = []

    def put(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.append((key, spark.conf.get(key, None)))
            spark.conf.set(key, value)

    yield put
    for key, value in reversed(changed):
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture(scope="module")
def stored(spark, feeds, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    warehouse = Warehouse(spark, root).create(NOW)
    ingest.run_batch(warehouse, feeds.raw, 0, NOW)
    warehouse.land(feeds.raw.drop("seq").withColumn("reject_reason", F.lit("")), 0)
    return warehouse


def test_lookbacks_reach_the_scan(stored):
    text = plan(views.ingestion_metrics(stored, NOW))
    scan = re.search(r"FileScan parquet.*", text).group()
    pruned = re.search(r"PartitionFilters: \[[^]]*", scan).group()
    assert "accepted" in pruned and "ingestion_date" in pruned
    assert "GreaterThanOrEqual(ingestion_time" in scan
    assert "raw_json" not in scan and "accepted" in scan and "reader_id" not in scan


def test_every_layer_prunes_by_load_date(stored):
    quality = views.data_quality_metrics(stored, NOW)
    for table, date in (
        ("landing", "ingestion_date"), ("stg", "staging_date"), ("facts", "fact_load_date")
    ):
        (scan,) = scans(quality, table)
        assert date in re.search(r"PartitionFilters: \[[^]]*", scan).group()


def test_json_is_parsed_once_per_line(feeds):
    good, bad = validate_events(feeds.json_lines().select("value"), NOW)
    assert plan(good).count("from_json") == plan(bad).count("from_json") == 1


def test_latest_copy_is_limited_before_the_shuffle(feeds):
    text = plan(facts.stage_batch(feeds.raw))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_active_badges_scans_once_and_combines_before_the_shuffle(stored):
    badges = views.active_badges(stored, NOW)
    assert len(scans(badges, "landing")) == 1
    assert "partial_max_by" in plan(badges)


def test_quality_metrics_scan_each_layer_once(stored):
    quality = views.data_quality_metrics(stored, NOW)
    assert [len(scans(quality, name)) for name in ("landing", "stg", "facts")] == [1, 1, 1]
    text = plan(quality)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_the_batch_dates_of_the_facts_are_read(stored):
    staged = stored.staged_in(0).filter("event_timestamp < '2024-01-03'")
    rows = facts.load_facts(
        staged, stored.users, stored.zones, stored.facts, dates=facts.dates_present(staged))
    (scan,) = scans(rows, "facts")
    pruned = re.search(r"PartitionFilters: \[[^]]*", scan).group()
    assert re.search(r"event_date#\d+ IN \([^,)]+,[^,)]+\)", pruned)


def test_ids_are_combined_before_a_large_dimension_is_joined(stored, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    text = plan(dims.unknown_user_ids(stored.raw, stored.users))
    assert text.index("SortMergeJoin") < text.index("HashAggregate")


def test_no_dimension_is_broadcast_regardless_of_size(stored, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    staged = stored.staged_in(0)
    for df in (
        facts.load_facts(staged, stored.users, stored.zones, stored.facts),
        dims.orphan_events(stored.raw, stored.users, stored.zones),
        dims.orphan_ids(stored.raw, dims.current(stored.users), "user_id"),
        views.data_quality_metrics(stored, NOW),
        views.active_badges(stored, NOW),
    ):
        assert "Broadcast" not in plan(df)


def test_a_hot_user_is_split(spark, stored, conf):
    """A third of all rows under one user id, joined to a dimension too big to broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
    )
    n = 60000
    hot = F.when(F.col("id") % 3 == 0, "USR-001").otherwise(
        F.concat(F.lit("U"), F.col("id") % 5000))
    staged = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("B"), "id").alias("badge_id"), hot.alias("user_id"),
        F.lit("ZONE-LOBBY-1").alias("zone_id"), F.lit("R").alias("reader_id"),
        (F.lit(NOW) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
        .alias("event_timestamp"))
    users = stored.users.filter("user_id = 'USR-001'").unionByName(
        dims.new_user_rows(staged, stored.users, NOW, 100))
    enriched = facts.enrich(staged, users, stored.zones)
    assert enriched.agg(F.countDistinct("badge_id")).first()[0] == n
    assert "skew=true" in plan(enriched, final=True)


def test_a_date_holding_most_rows_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="64KB")
    rows = spark.range(0, 60000, 1, 8).select(
        F.col("id"), F.date_sub(F.lit(NOW.date()), F.when(F.col("id") % 3 > 0, 0)
                                .otherwise(F.col("id") % 5).cast("int")).alias("event_date"),
        F.lit(NOW).alias("event_timestamp"), F.uuid().alias("payload"))
    out = str(tmp_path / "facts")
    cluster_by_date(rows).write.partitionBy("event_date").parquet(out)
    files = spark.read.parquet(out).inputFiles()
    today = [f for f in files if f"event_date={NOW.date()}" in f]
    assert len(today) > 2 and spark.read.parquet(out).count() == 60000


def test_copies_of_one_key_holding_a_third_of_all_rows(spark, raw_rows):
    n = 30000
    third = F.col("id") % 3 == 0
    rows = spark.range(0, n, 1, 8).select(
        F.when(third, "HOT").otherwise(F.concat(F.lit("B"), "id")).alias("badge_id"),
        F.lit(NOW).alias("event_timestamp"),
        (F.lit(NOW) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
        .alias("ingestion_time"), F.col("id").alias("seq"))
    kept = selection.latest_per_key(rows)
    assert kept.count() == n - n // 3 + 1
    assert kept.filter("badge_id = 'HOT'").first().seq == n - 3
    assert selection.duplicate_keys(rows).first().copies == n // 3


def test_a_badge_lookup_skips_row_groups(spark, tmp_path):
    badge = F.concat(F.lit("B"), (F.xxhash64("id") % 10**9 + 2 * 10**9).cast("string"))
    rows = spark.range(0, 300000, 1, 1).select(badge.alias("badge_id"), F.uuid().alias("v"))
    path = str(tmp_path / "rows")
    rows.write.options(**BADGE_LOOKUP).parquet(path)
    lookup = spark.read.parquet(path).filter("badge_id = 'B2000000013'")
    assert lookup.collect() == []
    scan = lookup._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numOutputRows").get().value() == 0


def test_top_n_never_sorts_the_table(stored):
    from gatelog.plans import reports

    assert "TakeOrderedAndProject" in plan(reports.latest_raw_events(stored))
    text = plan(reports.fact_details(stored))
    assert "TakeOrderedAndProject" in text or "GlobalLimit" in text


def test_streamed_hours_equal_the_batch(feeds, spark, tmp_path):
    from gatelog.catalog.feeds import Feeds, badge_feed

    live = Feeds(spark, feeds.sf_dir)
    live.badge_feed = badge_feed(feeds.stream("events"))
    columns = ingest.hourly_metrics(live.raw, watermark="2 hours")
    query = columns.writeStream.outputMode("append").format("parquet").option(
        "checkpointLocation", str(tmp_path / "ckpt")
    ).trigger(availableNow=True).start(str(tmp_path / "hours"))
    query.awaitTermination()
    closed = spark.read.schema(columns.schema).parquet(str(tmp_path / "hours"))
    whole = ingest.hourly_metrics(feeds.raw)
    assert closed.exceptAll(whole).isEmpty()
    newest = feeds.raw.agg(F.max("ingestion_time")).first()[0]
    done = whole.filter(F.col("ingestion_hour") < F.lit(newest - timedelta(hours=3)))
    assert done.exceptAll(closed).isEmpty()
