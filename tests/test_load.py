"""The load over real files: replay, failures, late keys, streams against batch."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from shared import NOW
from pyspark.sql import functions as F

from gatelog.operators.selection import EVENT_KEY, duplicate_keys
from gatelog.plans import reports, views
from gatelog.sources.events import (
    Retries, accepted, classify_events, dedupe_retries, first_sends, read_events,
)
from gatelog.streaming import ingest

ONCE = {"availableNow": True}
MINUTE = timedelta(minutes=1)


def keys(df):
    return sorted(map(tuple, df.select(*EVENT_KEY).collect()))


def snapshot(warehouse):
    return (
        keys(warehouse.stg), keys(warehouse.facts),
        sorted(r.user_id for r in warehouse.users.collect()),
    )


@pytest.fixture
def batches(raw_rows):
    return [
        raw_rows(
            {"badge_id": "B1"}, {"badge_id": "B1", "ingestion_time": NOW + MINUTE},
            {"badge_id": "B2", "user_id": "NEW-1"}, {"badge_id": "B3", "zone_id": "nowhere"}),
        raw_rows(
            {"badge_id": "B1", "zone_id": "ZONE-CONF-3B"}, {"badge_id": "B4", "user_id": "NEW-1"},
            {"badge_id": "B3"}),
    ]


def test_batches_dedupe_within_themselves_only(warehouse, batches):
    for i, batch in enumerate(batches):
        ingest.run_batch(warehouse, batch, i, NOW)
    assert [k[0] for k in keys(warehouse.stg)] == ["B1", "B1", "B2", "B3", "B3", "B4"]
    # B3's first copy had an unknown zone, so its second copy is loaded
    assert [k[0] for k in keys(warehouse.facts)] == ["B1", "B2", "B3", "B4"]
    assert warehouse.users.filter("user_id = 'NEW-1'").count() == 1
    b1 = warehouse.facts.filter("badge_id = 'B1'").first()
    assert b1.zone_key == 1 and b1.ingestion_time == NOW + MINUTE


def test_replaying_a_batch_changes_nothing(warehouse, batches):
    for i, batch in enumerate(batches):
        ingest.run_batch(warehouse, batch, i, NOW)
    before = snapshot(warehouse)
    ingest.run_batch(warehouse, batches[1], 1, NOW + MINUTE)
    assert snapshot(warehouse) == before


def test_a_failed_load_is_logged_and_completed_on_replay(warehouse, batches, monkeypatch):
    ingest.run_batch(warehouse, batches[0], 0, NOW)
    monkeypatch.setattr(warehouse, "append_facts", lambda df, run: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.run_batch(warehouse, batches[1], 1, NOW)
    monkeypatch.undo()
    failed = warehouse.batch_log.filter("state = 'FAILED'").first()
    assert (failed.name, failed.error_code) == (ingest.FACT_TASK, "ZeroDivisionError")
    ingest.run_batch(warehouse, batches[1], 1, NOW)
    assert len(keys(warehouse.facts)) == 4 and duplicate_keys(warehouse.facts).isEmpty()


def lose_fact_entries(monkeypatch):
    """The driver dies after the facts are written and before the log is."""
    real = ingest.log_batch

    def log(wh, name, *args, **fields):
        if name == ingest.FACT_TASK:
            raise OSError("driver lost")
        real(wh, name, *args, **fields)

    monkeypatch.setattr(ingest, "log_batch", log)


def assert_unique_keys(warehouse, n):
    rows, keys_found = warehouse.facts.agg(F.count("*"), F.countDistinct("event_key")).first()
    assert rows == keys_found == n


def test_fact_keys_stay_unique_when_the_log_entry_was_lost(warehouse, batches, monkeypatch):
    lose_fact_entries(monkeypatch)
    with pytest.raises(OSError):
        ingest.run_batch(warehouse, batches[0], 0, NOW)
    monkeypatch.undo()
    for i, batch in enumerate(batches):
        ingest.run_batch(warehouse, batch, i, NOW)
    assert_unique_keys(warehouse, 4)


def test_a_lost_procedure_call_does_not_cost_key_uniqueness(warehouse, batches, monkeypatch):
    warehouse.write_staging(
        batches[0].drop("raw_json").withColumn("staging_time", F.lit(NOW)), 0)
    lose_fact_entries(monkeypatch)
    with pytest.raises(OSError):
        ingest.process_badge_events(warehouse, NOW)
    monkeypatch.undo()
    ingest.run_batch(warehouse, batches[1], 1, NOW)
    assert_unique_keys(warehouse, 5)  # the procedure loads both staged copies of B1
    last = warehouse.batch_log.filter(F.col("name") == ingest.FACT_TASK).first()
    assert last.max_event_key == warehouse.facts.agg(F.max("event_key")).first()[0]


def test_table_wide_dedupe_keeps_the_first_batch(warehouse, batches):
    options = ingest.LoadOptions(dedupe_scope="table")
    for i, batch in enumerate(batches):
        ingest.run_batch(warehouse, batch, i, NOW, options)
    assert [k[0] for k in keys(warehouse.stg)] == ["B1", "B2", "B3", "B4"]
    before = snapshot(warehouse)
    ingest.run_batch(warehouse, batches[1], 1, NOW, options)
    assert snapshot(warehouse) == before


def test_left_joined_facts_keep_unknown_zones(warehouse, batches):
    options = ingest.LoadOptions(dimension_join="left")
    ingest.run_batch(warehouse, batches[0], 0, NOW, options)
    zones = {r.badge_id: r.zone_key for r in warehouse.facts.collect()}
    assert zones == {"B1": 1, "B2": 1, "B3": None}


def test_faint_signals_can_be_left_out_of_staging(warehouse, raw_rows):
    rows = raw_rows(*[
        {"badge_id": str(s), "signal_strength": Decimal(s)} for s in (-95, -85, -999)])
    ingest.run_batch(warehouse, rows, 0, NOW, ingest.LoadOptions(signal_floor=-90))
    assert [k[0] for k in keys(warehouse.stg)] == ["-85", "-999"]


def test_an_empty_batch_is_not_a_run(warehouse, batches):
    ingest.run_batch(warehouse, batches[0].limit(0), 0, NOW)
    assert warehouse.batch_log.isEmpty()


def test_the_procedure_loads_what_is_staged_and_reports(warehouse, batches):
    for i, batch in enumerate(batches):
        warehouse.write_staging(
            batch.drop("raw_json").withColumn("staging_time", F.lit(NOW)), i)
    first = ingest.process_badge_events(warehouse, NOW)
    again = ingest.process_badge_events(warehouse, NOW)
    # both staged copies of B1 pass in one call, as does the third from the second batch
    assert first == {"status": "COMPLETED", "facts_loaded": 6}
    assert again["facts_loaded"] == 0


def test_streams_equal_batches(spark, warehouse, tmp_path):
    """Lines arriving in several files, landed and loaded by streams."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    checkpoint = str(tmp_path / "ckpt")
    lines = []
    for i in range(60):
        event = {
            "badge_id": f"B{i % 20}", "user_id": f"USR-00{1 + i % 7}",
            "zone_id": "ZONE-LOBBY-1" if i % 9 else "nowhere", "reader_id": "RDR-101",
            "event_timestamp": f"2024-01-{1 + i % 20:02d}T10:00:00",
        }
        lines.append(json.dumps(event) if i % 13 else json.dumps(event)[:-1])

    def run():
        source = read_events(spark, str(inbox))
        ingest.start_landing(
            source, warehouse, f"{checkpoint}/landing", ONCE).awaitTermination()
        changes = ingest.read_changes(warehouse)
        ingest.start_load(
            changes, warehouse, f"{checkpoint}/load", ONCE).awaitTermination()

    for part in range(2):
        (inbox / f"part-{part}.json").write_text("\n".join(lines[part * 30:][:30]) + "\n")
        run()
    before = snapshot(warehouse)
    run()  # nothing new has arrived
    assert snapshot(warehouse) == before
    good = [json.loads(text) for i, text in enumerate(lines) if i % 13]
    assert warehouse.raw.count() == len(good)
    assert warehouse.quarantine.count() == 60 - len(good)
    per_batch = {(e["badge_id"], e["event_timestamp"], i // 30)
                 for i, e in enumerate(json.loads(t) if j % 13 else None
                                       for j, t in enumerate(lines)) if e}
    assert warehouse.stg.count() == len(per_batch)
    known = {(e["badge_id"], e["event_timestamp"]) for e in good if e["zone_id"] != "nowhere"}
    assert {(b, f"{t:%Y-%m-%dT%H:%M:%S}") for b, t in keys(warehouse.facts)} == known
    assert warehouse.users.count() == 7
    log = warehouse.batch_log.groupBy("name", "state").count().collect()
    assert {(r.name, r.state): r["count"] for r in log} == {
        (ingest.STAGE_TASK, "SUCCEEDED"): 2, (ingest.FACT_TASK, "SUCCEEDED"): 2}
    now = ingest.utc_now()
    assert views.data_quality_metrics(warehouse, now).first().total_raw_events == len(good)
    assert reports.load_history(reports.batch_loads(warehouse.batch_log), now).count() == 2
    assert {r.status for r in reports.channel_table(warehouse.batch_log, now).collect()} == {
        "OPEN"}


def test_a_token_resent_without_end_is_kept_once(spark, tmp_path):
    rows = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("token"),
        F.lit(NOW).alias("sent"), F.lit(Decimal("1.50")).alias("amount"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    once = dedupe_retries(stream, "token", "sent", timedelta(hours=1))
    once.writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "ckpt")
    ).trigger(**ONCE).start(str(tmp_path / "out")).awaitTermination()
    kept = spark.read.schema(once.schema).parquet(str(tmp_path / "out"))
    whole = dedupe_retries(rows, "token", "sent", timedelta(hours=1))
    assert kept.count() == whole.count() == 6001
    assert kept.exceptAll(whole).isEmpty()


def test_deployment_metadata_is_one_row(warehouse):
    for account in ("one", "two"):
        warehouse.write_run_metadata(account, NOW.date(), NOW)
    assert [r.account_identifier for r in warehouse.run_metadata.collect()] == ["two"]


def test_a_timely_copy_survives_beside_a_late_one(spark, tmp_path):
    """A late and a timely copy of a token in one file: the event is kept."""
    start = datetime(2024, 1, 1)
    files = [
        [(1, start + timedelta(hours=5))],
        [(7, start), (7, start + timedelta(hours=5)), (2, start + timedelta(hours=5))],
        [(7, start + timedelta(hours=5, minutes=1))],
    ]
    inbox = tmp_path / "inbox"
    for i, rows in enumerate(files):
        frame = spark.createDataFrame(rows, "token int, at timestamp_ntz").coalesce(1)
        frame.write.mode("append").parquet(str(inbox))
        for new in sorted(inbox.glob("part-*.parquet")):
            new.rename(inbox / f"{i}-{new.name.removeprefix('part-')}")
    stream = spark.readStream.schema("token int, at timestamp_ntz").option(
        "maxFilesPerTrigger", 1).parquet(str(inbox))
    once = dedupe_retries(stream, "token", "at", timedelta(hours=1))
    once.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(
        availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(r.token for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 7]


def sends(tokens):
    """Lines with a token each; the reader tells copies apart."""
    return [
        json.dumps({
            "badge_id": f"B{t}", "user_id": "USR-001", "zone_id": "ZONE-LOBBY-1", "reader_id": f"R{i}",
            "event_timestamp": "2024-01-31T08:00:00", "token": t})
        for i, t in enumerate(tokens)]


def test_resent_lines_land_once_as_in_one_batch(spark, warehouse):
    """Batches minutes apart through landing, and the rule over all their lines at once, keep the same rows."""
    batches = [  # minutes, tokens
        (0, ["a"] * 400 + ["b", None, None]), (50, ["a", "c"]), (100, ["a", "b", "c"]), (161, ["a", "b", "c"]),
        (162, ["a"]), (300, [None, "a", "d"])]
    rule, lines = Retries(delay=timedelta(hours=1)), []
    for batch_id, (minutes, tokens) in enumerate(batches):
        frame = spark.createDataFrame([(v,) for v in sends(tokens)], "value string").repartition(3)
        classified = classify_events(frame, NOW + minutes * MINUTE)
        lines.append(classified)
        for _ in range(1 + (batch_id == 3)):  # a repeated batch does not meet its own tokens
            warehouse.land(classified, batch_id, rule)
    every = lines[0]
    for more in lines[1:]:
        every = every.unionByName(more)
    whole = accepted(first_sends(rule.tokens(every), "retry_token", "ingestion_time", rule.delay))
    kept = warehouse.raw.drop("ingestion_date")
    assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()
    by_badge = {r.badge_id: r["count"] for r in kept.groupBy("badge_id").count().collect()}
    # a: 0-100 are one row of copies, 161 follows 61 minutes later; b, c alike; 300 is new again
    assert by_badge == {"Ba": 3, "Bb": 3, "Bc": 2, "Bd": 1, "BNone": 3}


def test_a_rejected_line_does_not_hide_its_correction(spark, warehouse):
    bad = json.dumps({"badge_id": "B1", "token": "t"})
    for batch_id, lines in enumerate(([bad], sends(["t"]), [bad])):
        frame = spark.createDataFrame([(v,) for v in lines], "value string")
        warehouse.land(classify_events(frame, NOW + batch_id * MINUTE), batch_id, Retries())
    assert warehouse.raw.count() == 1 and warehouse.quarantine.count() == 2


def test_landing_stream_leaves_out_resent_lines(spark, warehouse, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i, tokens in enumerate((["a", "a", "b"], ["b", "c"], ["a", "d"])):
        (inbox / f"{i}.json").write_text("\n".join(sends(tokens)))
        stream = read_events(spark, str(inbox))
        ingest.start_landing(
            stream, warehouse, str(tmp_path / "ckpt"), ONCE, Retries(delay=timedelta(hours=1))
        ).awaitTermination()
    assert sorted(r.badge_id for r in warehouse.raw.collect()) == ["Ba", "Bb", "Bc", "Bd"]
    assert len(warehouse.files.names(warehouse.path("changes"))) == 3


def test_a_token_resent_without_end_is_combined_before_the_shuffle(spark):
    """A token with 10^5 copies, a microsecond to a second apart: a row per span and task is shuffled."""
    rows = spark.range(0, 150_000, 1, 4).select(
        F.when(F.col("id") < 100_000, "hot").otherwise(F.col("id").cast("string")).alias("token"),
        (F.lit(NOW).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") / 50)).alias("at"))
    once = first_sends(rows, "token", "at", timedelta(minutes=10))
    assert once.count() == 50_001
    assert once.filter("token = 'hot'").first()["at"] == NOW
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan


def test_rows_of_copies_by_brute_force(spark):
    import random

    chance = random.Random(5)
    rows = [(chance.choice("abcde") if chance.random() > 0.1 else None,
             NOW + timedelta(seconds=chance.randrange(20_000)), chance.randrange(3)) for _ in range(300)]
    rows += [("f", NOW, 2), ("f", NOW, 1), ("f", NOW + timedelta(seconds=60), 0), ("f", NOW + timedelta(seconds=121), 0)]
    want, last = [], {}
    for token, at, n in sorted(rows, key=lambda r: (r[1], r[2])):
        if token is None or token not in last or at - last[token] > timedelta(seconds=60):
            want.append((token, at, n))
        last[token] = at
    frame = spark.createDataFrame(rows, "token string, at timestamp_ntz, n int").repartition(3)
    got = first_sends(frame, "token", "at", timedelta(seconds=60)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_staging_is_written_without_a_sort_by_its_one_day(spark, warehouse, batches, monkeypatch):
    """The stamp is one value: sorting rows by it once more, to write one folder, is no use."""
    seen = []
    replace = type(warehouse.day_tables["stg"]).replace

    def watched(table, rows, run, **options):
        if table.day == "staging_date":
            seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return replace(table, rows, run, **options)

    monkeypatch.setattr(type(warehouse.day_tables["stg"]), "replace", watched)
    ingest.run_batch(warehouse, batches[0], 0, NOW)
    # the day is a constant above the count of rows, which Spark does not look through
    (text,) = seen
    assert text.index("staging_date") < text.index("CollectMetrics")
    assert text.count("staging_date") == 1 and "to_date" not in text and "cast(staging_time" not in text
    assert warehouse.stg.select("staging_time").distinct().count() == 1


def test_totals_of_many_load_times_are_not_written_by_one_task(spark, warehouse, raw_rows):
    times = [{"badge_id": f"B{i}", "ingestion_time": NOW + i * timedelta(seconds=1)} for i in range(400)]
    rows = raw_rows(*times).withColumn("reject_reason", F.lit(""))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        warehouse.land(rows, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    totals = warehouse.totals
    assert totals.count() == 400 and totals.agg(F.sum("row_count")).first()[0] == 400
    assert len(totals.inputFiles()) > 1


def test_facts_are_counted_per_task_in_one_job(spark, warehouse, batches, monkeypatch):
    counted = []
    task_counts = ingest.task_counts
    monkeypatch.setattr(
        ingest, "task_counts", lambda rows, row: counted.append(task_counts(rows, row)) or counted[-1])
    ingest.run_batch(warehouse, batches[0], 0, NOW)
    assert [sum(c.values()) for c in counted] == [warehouse.facts.count()]
    assert sorted(r.event_key for r in warehouse.facts.collect()) == [1, 2]


def test_steps_run_side_by_side_and_all_end_before_one_fails(spark):
    from threading import Barrier

    from gatelog.session import together

    both, ended = Barrier(2, timeout=60), []

    def fails():
        both.wait()
        raise ValueError("no")

    def ends():
        both.wait()
        ended.append(spark.range(3).count())

    with pytest.raises(ValueError):
        together(spark, [fails, ends])
    assert ended == [3] and together(spark, [lambda: 1, lambda: 2]) == [1, 2] and together(spark, []) == []


def test_a_batch_of_the_catalog_reads_its_own_rows_only(spark, feeds):
    from gatelog.catalog import incremental

    for expression, n in ((incremental.SPAN, incremental.SPANS), (incremental.SLICE, 3)):
        split = incremental.batches(feeds, expression, n)
        for i, batch in split:
            metadata = batch.select("_metadata.file_path").distinct().collect()
            assert metadata and all(f"_batch={i}/" in r[0] for r in metadata)
            assert batch.schema.names == feeds.raw.schema.names
            wanted = feeds.raw.filter(F.expr(f"{expression} = {i}"))
            assert batch.exceptAll(wanted).isEmpty() and wanted.exceptAll(batch).isEmpty()
