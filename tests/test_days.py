"""Daily folders: merging under readers and loads, newest rows, versions, streams that list little."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from shared import NOW

from gatelog.operators import dims
from gatelog.plans import kpis, reports, views
from gatelog.sources import days
from gatelog.sources.days import DayTable, VersionTable, first_last
from gatelog.sources.events import read_events
from gatelog.streaming import ingest

ONCE = {"availableNow": True}


@pytest.fixture
def table(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType().add("n", "integer").add("day", "date")
    made = DayTable(spark, str(tmp_path), "numbers", schema, "day")
    made.create()
    return made


def put(table, run, *rows, how="append"):
    frame = table.spark.createDataFrame([(n, date(2024, 1, d)) for d, n in rows], table.schema)
    getattr(table, how)(frame.coalesce(1), f"b{run:012d}")


def numbers(df):
    return sorted(r.n for r in df.collect())


def test_a_repeated_run_replaces_its_part(table):
    assert numbers(table.read()) == [] and table.days() == []
    put(table, 0, (1, 1), (2, 2), how="replace")
    put(table, 1, (2, 3), how="replace")
    put(table, 1, (2, 4), how="replace")
    assert numbers(table.read()) == [1, 2, 4]
    assert numbers(table.read(without="b000000000001")) == [1, 2]
    assert numbers(table.read_days(["2024-01-02", "2024-01-09"])) == [2, 4]
    assert numbers(table.read_days([date(2024, 1, 2)], run="b000000000000")) == [2]
    table.remove("b000000000001")
    assert numbers(table.read()) == [1, 2]


def test_merging_keeps_rows_and_bounds_parts(table):
    for run in range(40):
        put(table, run, (1 + run % 3, run))
        if run % 10 == 9:
            before = table.read()  # a reader that has listed the files
            assert table.merge() > 0
            assert numbers(before) == numbers(table.read()) == list(range(run + 1))
    table.merge()
    table.merge()
    for day in table.days():
        assert len(table._parts(day)) <= 2  # one merged part, and the newest run's
    assert table.files.names(table.swaps) == [] and numbers(table.read()) == list(range(40))
    put(table, 40, (3, 40))
    assert numbers(table.runs_after("b000000000039")) == [40]
    assert table.runs_after("b000000000040") is None and table.newest_run("b") == "b000000000040"


def test_lanes_sizes_and_limits(table):
    for run in range(4):
        put(table, run, (1, run))
    rows = table.spark.createDataFrame([(9, date(2024, 1, 1))], table.schema)
    for call in range(3):
        table.append(rows, f"c{call:012d}")
    table.merge(before="b000000000002")
    visible = {r.part for r in table._of([table.path], parts=True).select("part").distinct().collect()}
    assert visible == {
        "b000000000000~b000000000001", "b000000000002", "b000000000003",
        "c000000000000~c000000000001", "c000000000002"}
    assert table.merge(target=1) == 0  # every part is large enough
    assert numbers(table.read()) == [0, 1, 2, 3, 9, 9, 9]
    assert first_last("a~b") == ("a", "b") and first_last("a") == ("a", "a")


def test_a_merge_that_is_lost_changes_nothing(table, monkeypatch):
    for run in range(4):
        put(table, run, (1, run))
    real = table.files.mark

    def stop(path, **how):
        if "/done@" in path:
            raise OSError("driver lost")
        real(path, **how)

    monkeypatch.setattr(table.files, "mark", stop)
    with pytest.raises(OSError):
        table.merge()
    monkeypatch.undo()
    assert numbers(table.read()) == [0, 1, 2, 3]  # the merged part is there and not read
    assert table.merge() == 3 and numbers(table.read()) == [0, 1, 2, 3]


def test_newest_asks_no_more_days_than_needed(table, monkeypatch):
    for run in range(6):
        put(table, run, *[(1 + run, 10 * run + i) for i in range(3)])
    asked = []
    real = table.read_days
    monkeypatch.setattr(table, "read_days", lambda own, run=None: asked.append(list(own)) or real(own, run))
    assert numbers(table.newest(2)) == [50, 51, 52] and len(asked) == 2
    assert numbers(table.newest(4)) == [40, 41, 42, 50, 51, 52]
    assert numbers(table.newest(2, lambda df: df.filter("n % 10 = 0"))) == [40, 50]
    assert len(numbers(table.newest(100))) == 18


def test_versions(spark, tmp_path):
    from pyspark.sql import types as T

    table = VersionTable(spark, str(tmp_path), "zones", T.StructType().add("n", "integer"))
    table.create(spark.range(1).select(F.col("id").cast("int").alias("n")))
    old = table.read()
    table.replace(spark.createDataFrame([(7,), (8,)], "n int"))
    assert numbers(old) == [0] and numbers(table.read()) == [7, 8]
    table.append(spark.createDataFrame([(9,)], "n int"))
    table.replace(table.read().filter("n > 7"))  # read from the version before
    assert numbers(table.read()) == [8, 9] and table.version == 3
    assert table.files.names(table.marks) == ["000000002", "000000003"]


def test_loads_and_merges_together(warehouse, raw_rows):
    """Facts are equal whether small files are merged between batches or not; files per date stay few."""
    for i in range(8):
        rows = raw_rows(
            {"badge_id": f"B{i}"}, {"badge_id": f"B{i}", "event_timestamp": NOW - timedelta(days=1)},
            {"badge_id": "hot"}, {"badge_id": f"B{i}", "zone_id": "nowhere", "event_timestamp": NOW + timedelta(hours=1)})
        ingest.run_batch(warehouse, rows, i, NOW, ingest.LoadOptions(compact_every=3))
        ingest.run_batch(warehouse, rows, i, NOW)  # a replay
    facts = warehouse.facts.groupBy("badge_id", "event_date").count().collect()
    assert len(facts) == 17 and {r["count"] for r in facts} == {1}
    assert warehouse.stg.count() == 8 * 4 and warehouse.stg.select("batch_id").distinct().count() == 8
    warehouse.compact()
    warehouse.compact()
    for name, table in warehouse.day_tables.items():
        for day in table.days():
            assert len(table._parts(day)) <= (2 if name != "batch_log" else 6), name
    assert warehouse.facts.count() == 17
    assert warehouse.totals.filter("layer = 'ANALYTICS'").agg(F.sum("row_count")).first()[0] == 17


def test_waiting_rows_are_read_only_for_new_zones(spark, warehouse, raw_rows, monkeypatch):
    zones = spark.createDataFrame(warehouse.zones.collect(), warehouse.zones.schema)
    read = []
    real = warehouse.freed
    monkeypatch.setattr(warehouse, "freed", lambda new: read.append(1) or real(new))
    for i in range(3):
        ingest.run_batch(warehouse, raw_rows({"badge_id": f"W{i}", "zone_id": f"Z{i}"}), i, NOW)
    assert not read and warehouse.facts.isEmpty()
    added = zones.limit(1).withColumn("zone_id", F.lit("Z1")).withColumn("zone_key", F.lit(99).cast("bigint"))
    warehouse.replace_zones(zones.union(added))
    ingest.run_batch(warehouse, raw_rows({"badge_id": "K"}), 3, NOW)
    assert len(read) == 1 and {r.badge_id for r in warehouse.facts.collect()} == {"K", "W1"}
    files = {f for f in warehouse.day_tables["waiting"].read().inputFiles()}
    ingest.run_batch(warehouse, raw_rows({"badge_id": "K2"}), 4, NOW)
    assert len(read) == 1
    assert {f for f in warehouse.day_tables["waiting"].read().inputFiles()} == files
    warehouse.replace_zones(zones)  # the zone goes, and comes again
    ingest.run_batch(warehouse, raw_rows({"badge_id": "K3", "zone_id": "Z1"}), 5, NOW)
    warehouse.replace_zones(zones.union(added))
    ingest.run_batch(warehouse, raw_rows({"badge_id": "K4"}), 6, NOW)
    assert {r.badge_id for r in warehouse.facts.collect()} == {"K", "W1", "K2", "K3", "K4"}


def test_streams_list_little_and_land_once(spark, warehouse, tmp_path):
    """Twelve files, one a batch; then a landing batch that is run again, and a new checkpoint."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    waiting = []

    def run(checkpoint, **options):
        lines = read_events(spark, str(inbox), **options)
        landing = ingest.start_landing(lines, warehouse, str(tmp_path / checkpoint / "landing"), ONCE)
        landing.awaitTermination()
        changes = ingest.read_changes(warehouse)
        ingest.start_load(changes, warehouse, str(tmp_path / checkpoint / "load"), ONCE).awaitTermination()
        waiting.append(len(warehouse.files.names(warehouse.path("changes"))))
        return landing

    def write(i):
        event = {"badge_id": f"B{i}", "user_id": "USR-001", "zone_id": "ZONE-LOBBY-1", "reader_id": "R",
                 "event_timestamp": "2024-01-31T10:00:00"}
        (inbox / f"{i:03d}.json").write_text(json.dumps(event) + "\n" + "broken\n")

    for i in range(12):
        write(i)
    landing = run("one", maxFilesPerTrigger=1)
    assert len(landing.recentProgress) >= 12
    assert not (tmp_path / "warehouse" / "landing" / "_spark_metadata").exists()
    assert warehouse.raw.count() == warehouse.quarantine.count() == warehouse.facts.count() == 12
    for i in range(12, 16):
        write(i)
        run("one")
    assert max(waiting[1:]) <= 2  # what is loaded is not listed again
    assert warehouse.raw.count() == warehouse.facts.count() == 16
    row = warehouse.raw.orderBy(F.col("ingestion_time").desc(), "badge_id").first()
    again = spark.createDataFrame([row], warehouse.raw.schema).drop("ingestion_date")
    for _attempt in range(2):
        warehouse.land(again.withColumn("reject_reason", F.lit("")), 15)
    run("one")
    assert warehouse.raw.count() == warehouse.facts.count() == 16
    for old in inbox.iterdir():
        old.unlink()
    write(90)
    run("two")  # a lost checkpoint: numbers go on
    assert warehouse.raw.count() == warehouse.facts.count() == 17
    warehouse.compact()
    assert warehouse.raw.count() == 17 and warehouse.quarantine.count() == 17
    write(91)
    run("two")
    assert warehouse.facts.count() == 18
    total = views.data_freshness(warehouse, ingest.utc_now()).collect()
    assert [r.total_rows for r in total] == [18, 18]


def test_totals_need_no_scan_of_events(warehouse, raw_rows):
    for i in range(2):
        rows = raw_rows({"badge_id": f"B{i}"}, {"badge_id": f"C{i}", "ingestion_time": NOW - timedelta(days=2)})
        warehouse.land(rows.withColumn("reject_reason", F.lit("")), i)
        ingest.run_batch(warehouse, rows, i, NOW)
        ingest.run_batch(warehouse, rows, i, NOW)
    fresh = views.data_freshness(warehouse, NOW)
    for df in (fresh, kpis.freshness_table(warehouse, NOW), kpis.overview(warehouse, NOW)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "landing" not in text and "/facts" not in text and "totals" in text
    raw, loaded = fresh.collect()
    assert (raw.total_rows, raw.rows_last_hour, raw.last_event_timestamp) == (4, 2, NOW)
    assert (loaded.total_rows, loaded.rows_last_hour) == (4, 4)


def test_a_lost_attempt_is_in_the_totals(warehouse, raw_rows, monkeypatch):
    rows = raw_rows({"badge_id": "A"}, {"badge_id": "B"})
    monkeypatch.setattr(warehouse, "add_fact_totals", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.run_batch(warehouse, rows, 0, NOW)
    monkeypatch.undo()
    ingest.run_batch(warehouse, rows, 0, NOW)
    assert warehouse.totals.agg(F.sum("row_count")).first()[0] == warehouse.facts.count() == 2


def test_a_second_call_reads_no_staging(warehouse, raw_rows, monkeypatch):
    for i in range(3):
        staged = raw_rows({"badge_id": f"B{i}"}, {"badge_id": f"X{i}", "zone_id": "nowhere"})
        warehouse.write_staging(staged.drop("raw_json").withColumn("staging_time", F.lit(NOW)), i)
    assert ingest.process_badge_events(warehouse, NOW)["facts_loaded"] == 3
    monkeypatch.setattr(DayTable, "_of", lambda *a, **k: 1 / 0)
    assert ingest.process_badge_events(warehouse, NOW)["facts_loaded"] == 0
    monkeypatch.undo()
    warehouse.write_staging(raw_rows({"badge_id": "B9"}).drop("raw_json").withColumn("staging_time", F.lit(NOW)), 3)
    assert ingest.process_badge_events(warehouse, NOW)["facts_loaded"] == 1


def test_users_change_twice(spark, warehouse, raw_rows):
    users = warehouse.users.filter("user_id = 'USR-001'")
    before = warehouse.users
    n = before.count()
    for year in (2025, 2026):
        updates = dims.current(warehouse.users).filter("user_id = 'USR-001'").withColumn("department", F.lit(str(year)))
        merged = dims.scd2_apply(warehouse.users, updates, datetime(year, 1, 1), dims.next_key(warehouse.users, "user_key"))
        warehouse.replace_users(merged)
    assert warehouse.users.count() == n + 2 and before.filter("is_current").columns == users.columns
    rows = raw_rows(*[{"badge_id": str(y), "event_timestamp": datetime(y, 6, 1)} for y in (2020, 2024, 2025, 2026)],
                    {"badge_id": "new", "user_id": "NEW"})
    ingest.run_batch(warehouse, rows, 0, NOW, ingest.LoadOptions(user_version="event"))
    named = warehouse.facts.join(warehouse.users, "user_key")
    found = {r.badge_id: r.department for r in named.collect()}
    assert found == {"2020": "Engineering", "2024": "Engineering", "2025": "2025", "2026": "2026", "new": "UNKNOWN"}
    assert warehouse.users.select("user_key").distinct().count() == warehouse.users.count()


def test_hours_add_up_and_late_events_count(spark, raw_rows, tmp_path):
    rows = raw_rows(*[{"badge_id": str(i), "ingestion_time": NOW + timedelta(hours=i % 100)} for i in range(300)])
    path, inbox = str(tmp_path / "hours"), str(tmp_path / "in")
    for i in range(4):  # the third brings events of long closed hours
        part = rows.filter(F.col("badge_id").cast("int") % 4 == i).coalesce(1)
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        query = ingest.start_hourly_metrics(stream, path, str(tmp_path / "ckpt"), ONCE)
        query.awaitTermination()
        assert not query.lastProgress or not query.lastProgress["stateOperators"]
    whole = ingest.hourly_metrics(rows)
    hours = ingest.read_hourly_metrics(spark, path)
    assert hours.count() == 100 and hours.exceptAll(whole).isEmpty()
    ingest.hourly_table(spark, path).merge()
    assert ingest.read_hourly_metrics(spark, path).exceptAll(whole).isEmpty()
    assert ingest.read_hourly_metrics(spark, path, [NOW.date()]).count() == 12


def test_reports_of_newest_rows(warehouse, raw_rows):
    for i in range(3):
        at = NOW + timedelta(days=i)
        rows = raw_rows(*[{"badge_id": f"B{i}{n}", "ingestion_time": at, "event_timestamp": at} for n in range(6)])
        warehouse.land(rows.withColumn("reject_reason", F.lit("")), i)
        ingest.run_batch(warehouse, rows, i, at)
    newest = reports.latest_raw_events(warehouse)
    assert len({f.split("ingestion_date=")[1][:10] for f in newest.inputFiles()}) == 2  # of three
    want = [f"B2{n}" for n in range(6)] + [f"B1{n}" for n in range(4)]
    assert [r.badge_id for r in newest.collect()] == want
    assert [r.badge_id for r in reports.latest_staged(warehouse).collect()] == want
    assert {r.badge_id for r in reports.fact_details(warehouse).collect()} == set(want)
    assert reports.runs_by_prefix(warehouse, "raw_").count() == 3
    assert reports.failed_runs(warehouse).isEmpty()
    assert days.TARGET_BYTES >= 1 << 20
