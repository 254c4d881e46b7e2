from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from shared import NOW
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatelog import schemas
from gatelog.operators import dims, facts, selection, sequences
from gatelog.sources.seeds import seed_users, seed_zones

MINUTE = timedelta(minutes=1)


@pytest.fixture(scope="module")
def star(spark):
    return SimpleNamespace(users=seed_users(spark, NOW), zones=seed_zones(spark, NOW))


def test_latest_copy_wins_and_ties_are_stable(raw_rows):
    rows = raw_rows(
        {"ingestion_time": NOW, "zone_id": "old"},
        {"ingestion_time": NOW + MINUTE, "zone_id": "ZONE-A"},
        {"ingestion_time": NOW + MINUTE, "zone_id": "ZONE-B"},
        {"badge_id": "B2"},
    )
    staged = {r.badge_id: r.zone_id for r in facts.stage_batch(rows).collect()}
    assert staged == {"B1": "ZONE-B", "B2": "ZONE-LOBBY-1"}


def test_staging_keys_are_unique(feeds):
    assert selection.duplicate_keys(facts.stage_batch(feeds.raw)).isEmpty()


def test_unknown_zone_is_dropped_unless_left(raw_rows, star):
    staged = facts.stage_batch(raw_rows({}, {"badge_id": "B2", "zone_id": "nowhere"}))
    inner = facts.enrich(staged, star.users, star.zones)
    left = facts.enrich(staged, star.users, star.zones, how="left")
    assert [r.badge_id for r in inner.collect()] == ["B1"]
    assert {r.badge_id: r.zone_key for r in left.collect()} == {"B1": 1, "B2": None}


def test_two_current_rows_of_a_user_fan_out(raw_rows, star):
    doubled = star.users.unionByName(
        star.users.filter("user_id = 'USR-001'").withColumn("user_key", F.lit(99).cast("bigint"))
    )
    staged = facts.stage_batch(raw_rows({}))
    keys = [r.user_key for r in facts.enrich(staged, doubled, star.zones).collect()]
    assert sorted(keys) == [1, 99]


def test_loaded_events_are_skipped(spark, raw_rows, star):
    staged = facts.stage_batch(raw_rows({}, {"badge_id": "B2"}))
    enriched = facts.enrich(staged, star.users, star.zones)
    loaded = facts.fact_columns(enriched.filter("badge_id = 'B1'"), F.lit(1), NOW)
    again = facts.load_facts(staged, star.users, star.zones, loaded)
    assert [r.badge_id for r in again.collect()] == ["B2"]


def test_only_rows_of_dates_that_hold_facts_are_joined(spark, raw_rows, star):
    day = timedelta(days=1)
    staged = facts.stage_batch(raw_rows(
        {}, {"badge_id": "B2"}, {"event_timestamp": NOW + day}, {"badge_id": None, "event_timestamp": None},
        {"badge_id": None}))
    enriched = facts.enrich(staged, star.users, star.zones)
    loaded = facts.fact_columns(enriched.filter("badge_id = 'B1'"), F.lit(1), NOW)
    loaded = loaded.filter(F.col("event_timestamp") == NOW).cache()
    held = [NOW.date()]

    def new(given):
        rows = facts.load_facts(staged, star.users, star.zones, loaded, held=given)
        return sorted(map(str, rows.select(*selection.EVENT_KEY, "user_key").collect()))

    assert new(held) == new(None) and len(new(held)) == 4
    # the other dates' rows, however many there are, come without the join
    other = enriched.filter(F.to_date("event_timestamp") != NOW.date())
    assert facts.new_facts(other, loaded, held=[]).count() == 1
    text = facts.load_facts(staged, star.users, star.zones, loaded, held=held)._jdf.queryExecution()
    assert text.optimizedPlan().toString().lstrip().startswith("Union")
    loaded.unpersist()


def test_two_staged_copies_both_pass_unless_unique(spark, raw_rows, star):
    staged = raw_rows({}, {"ingestion_time": NOW + MINUTE, "zone_id": "ZONE-CONF-3B"})
    none = spark.createDataFrame([], schemas.FACTS)
    both = facts.load_facts(staged, star.users, star.zones, none)
    one = facts.load_facts(staged, star.users, star.zones, none, unique=True)
    assert both.count() == 2
    assert [r.zone_id for r in one.collect()] == ["ZONE-CONF-3B"]


def test_faint_signals(spark, raw_rows):
    from decimal import Decimal

    rows = raw_rows(*[
        {"badge_id": str(s), "signal_strength": None if s is None else Decimal(s)}
        for s in (-91, -90, -999, None)
    ])
    spared = {r.badge_id for r in facts.drop_faint(rows).collect()}
    strict = {r.badge_id for r in facts.drop_faint(rows, keep_missing=False).collect()}
    assert spared == {"-90", "-999", "None"} and strict == {"-90", "None"}


def test_dates_present_names_each_date(raw_rows):
    far = datetime(9998, 12, 30)
    rows = raw_rows(
        *[{"event_timestamp": NOW + timedelta(days=d)} for d in (0, 0, 3, 9)],
        {"event_timestamp": far})
    days = rows.sparkSession.range(12).select(
        F.date_add(F.lit(NOW.date()), F.col("id").cast("int")).alias("event_date"))
    assert days.filter(facts.dates_present(rows)).count() == 3


def test_new_users_get_unique_repeatable_keys(spark, raw_rows, star):
    rows = raw_rows(*[{"user_id": f"N{i}"} for i in range(40)], {"user_id": "USR-002"})
    new = dims.new_user_rows(rows, star.users, NOW, start=6)
    first, second = (sorted(map(tuple, new.collect()), key=str) for _ in range(2))
    assert first == second and len(first) == 40
    assert new.agg(F.countDistinct("user_key"), F.min("user_key") >= 6).first()[:] == (40, True)
    assert {r.clearance_level for r in new.collect()} == {"PUBLIC"}


def test_history_closes_changed_rows_only(spark, star):
    updates = spark.createDataFrame(
        [
            ("USR-001", "John Smith", "EMPLOYEE", "Security", "SECRET"),
            ("USR-002", "Jane Doe", "EMPLOYEE", "HR", "PUBLIC"),
            ("USR-900", "New Person", "VISITOR", None, "PUBLIC"),
        ],
        "user_id string, user_name string, user_type string, department string, "
        "clearance_level string",
    )
    later = NOW + timedelta(days=1)
    merged = dims.scd2_apply(star.users, updates, later, start=6)
    rows = {(r.user_id, r.is_current): r for r in merged.collect()}
    assert merged.count() == 7
    assert rows["USR-001", False].effective_end_date == later
    assert rows["USR-001", True].department == "Security"
    assert rows["USR-001", True].effective_start_date == later
    assert rows["USR-002", True].effective_end_date is None
    assert ("USR-002", False) not in rows and ("USR-900", True) in rows
    again = dims.scd2_apply(merged, updates, later + MINUTE, start=20)
    assert again.count() == 7  # nothing changed since


def test_not_in_with_a_null_in_the_list_selects_nothing(spark, raw_rows, star):
    rows = raw_rows({"user_id": "nobody"}, {"user_id": "USR-001"})
    ids = star.users.select("user_id")
    with_null = ids.unionByName(spark.createDataFrame([(None,)], "user_id string"))
    assert [r.user_id for r in dims.orphan_ids(rows, ids, "user_id").collect()] == ["nobody"]
    assert dims.orphan_ids(rows, with_null, "user_id").isEmpty()


def test_orphan_events_match_sql(spark, raw_rows, star):
    rows = raw_rows(
        {}, {"badge_id": "B2", "user_id": "nobody"}, {"badge_id": "B3", "zone_id": "nowhere"},
        {"badge_id": "B4", "user_id": None}, {"badge_id": "B5", "user_id": None, "zone_id": "x"},
    )
    rows.createOrReplaceTempView("r")
    star.users.createOrReplaceTempView("u")
    star.zones.createOrReplaceTempView("z")
    want = spark.sql(
        "SELECT badge_id FROM r WHERE user_id NOT IN (SELECT user_id FROM u WHERE is_current) "
        "OR zone_id NOT IN (SELECT zone_id FROM z)"
    )
    got = dims.orphan_events(rows, star.users, star.zones)
    assert sorted(r.badge_id for r in got.collect()) == sorted(r.badge_id for r in want.collect())


EVENT = st.tuples(
    st.sampled_from("AB"), st.sampled_from("XY"), st.integers(0, 400),
    st.sampled_from(["ENTRY", "EXIT", None]),
)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EVENT, min_size=1, max_size=40, unique_by=lambda e: (e[0], e[2])))
def test_dwell_times_equal_one_look_ahead(spark, events):
    start = datetime(2024, 1, 1)
    rows = [(b, z, start + m * 10 * MINUTE, d) for b, z, m, d in events]
    df = spark.createDataFrame(
        rows, "badge_id string, zone_id string, event_timestamp timestamp_ntz, direction string")
    got = {(r.badge_id, r.zone_id, r.entry_timestamp, r.dwell_time_minutes)
           for r in sequences.dwell_times(df).collect()}
    want = set()
    for place in {(b, z) for b, z, _, _ in rows}:
        here = [(t, d) for b, z, t, d in rows if (b, z) == place]
        line = sorted(here, key=lambda event: event[0])
        for (t, d), (t2, d2) in zip(line, line[1:]):
            if (d, d2) == ("ENTRY", "EXIT"):
                want.add((*place, t, (t2 - t).total_seconds() / 60))
    assert got == want


def test_long_stays_can_be_left_out(spark):
    rows = [("A", "X", NOW, "ENTRY"), ("A", "X", NOW + 90 * MINUTE, "EXIT")]
    df = spark.createDataFrame(
        rows, "badge_id string, zone_id string, event_timestamp timestamp_ntz, direction string")
    assert sequences.dwell_times(df).count() == 1
    assert sequences.dwell_times(df, max_stay=timedelta(hours=1)).isEmpty()


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=1, max_size=30))
def test_runs_equal_brute_force(spark, flags):
    from itertools import groupby

    df = spark.createDataFrame(list(enumerate(flags)), "i int, flag boolean")
    lengths = sequences.runs(df, [], [F.col("i")], F.col("flag")).groupBy("run").count()
    want = sorted(len(list(g)) for flag, g in groupby(flags) if flag)
    assert sorted(r["count"] for r in lengths.collect()) == want
