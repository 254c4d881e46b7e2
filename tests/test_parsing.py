"""Golden rows for the JSON source: typing, defaults, rounding, rejects."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from gatelog.sources.events import parse_events, validate_events, with_variant

LOAD = datetime(2024, 1, 31)
BASE = {
    "badge_id": "B1", "user_id": "U1", "zone_id": "Z1", "reader_id": "R1",
    "event_timestamp": "2025-12-02T10:30:00", "signal_strength": -65.5, "direction": "ENTRY",
}


def line(**changes):
    return json.dumps({k: v for k, v in {**BASE, **changes}.items() if v is not ...})


def split(spark, *lines):
    df = spark.createDataFrame([(text,) for text in lines], "value string")
    good, bad = validate_events(df, LOAD)
    return good.collect(), bad.collect()


@pytest.mark.parametrize(
    ("signal", "stored", "quality"),
    [
        (-65.5, "-66.00", "MEDIUM"),  # rounded half-up before it is classified
        (-80, "-80.00", "MEDIUM"),
        (-80.4, "-80.00", "MEDIUM"),
        (-80.5, "-81.00", "WEAK"),
        (-60, "-60.00", "STRONG"),
        (-59.5, "-60.00", "STRONG"),
        (-60.5, "-61.00", "MEDIUM"),
        ("-70", "-70.00", "MEDIUM"),
        (None, "-999.00", "STRONG"),
        (..., "-999.00", "STRONG"),  # the default is stored, the missing value classified
    ],
)
def test_signal(spark, signal, stored, quality):
    (row,), bad = split(spark, line(signal_strength=signal))
    assert (row.signal_strength, row.signal_quality, bad) == (Decimal(stored), quality, [])


@pytest.mark.parametrize(
    ("given", "kept"),
    [("entry", "ENTRY"), ("Exit", "EXIT"), ("sideways", "SIDEWAYS"), (None, None), (..., None)],
)
def test_direction(spark, given, kept):
    (row,), _ = split(spark, line(direction=given))
    assert row.direction == kept


@pytest.mark.parametrize(
    ("text", "moment"),
    [
        ("2025-12-02T10:30:00", datetime(2025, 12, 2, 10, 30)),
        ("2025-12-02T10:30:00Z", datetime(2025, 12, 2, 10, 30)),
        ("2025-12-02T10:30:00-05:00", datetime(2025, 12, 2, 10, 30)),  # wall clock is kept
        ("2025-12-02T10:30:00.25", datetime(2025, 12, 2, 10, 30, 0, 250000)),
    ],
)
def test_accepted_times(spark, text, moment):
    (row,), _ = split(spark, line(event_timestamp=text))
    assert row.event_timestamp == moment


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({"event_timestamp": "2025-12-02 10:30:00"}, "bad_event_timestamp"),
        ({"event_timestamp": "11/24/2024 10:30 AM"}, "bad_event_timestamp"),
        ({"event_timestamp": "2025-13-02T10:30:00"}, "bad_event_timestamp"),
        ({"badge_id": ...}, "missing_badge_id"),
        ({"user_id": None}, "missing_user_id"),
        ({"zone_id": "Z" * 51}, "too_long_zone_id"),
        ({"signal_strength": "loud"}, "bad_signal_strength"),
        ({"signal_strength": -1000}, "signal_strength_out_of_range"),
        ({"direction": "sideways-in"}, "too_long_direction"),
        ({"badge_id": ..., "reader_id": ...}, "missing_badge_id,missing_reader_id"),
    ],
)
def test_rejects(spark, changes, reason):
    good, (row,) = split(spark, line(**changes))
    assert (good, row.reject_reason) == ([], reason)


@pytest.mark.parametrize("text", ["{bad", "[]", "null", "", '"text"', line()[:-1]])
def test_malformed_json(spark, text):
    good, (row,) = split(spark, text)
    assert (good, row.reject_reason, row.value) == ([], "malformed_json", text)


def test_one_bad_field_spares_the_other_lines(spark):
    good, bad = split(spark, line(), line(signal_strength="x"), line(badge_id="B2"))
    assert sorted(r.badge_id for r in good) == ["B1", "B2"]
    assert len(bad) == 1


def test_fifty_characters_are_accepted(spark):
    good, bad = split(spark, line(zone_id="Z" * 50))
    assert len(good) == 1 and bad == []


def test_extra_fields_survive_in_the_payload(spark):
    df = spark.createDataFrame([(line(firmware={"v": [1, 2]}),)], "value string")
    row = with_variant(parse_events(df, LOAD)).selectExpr(
        "raw_json", "try_variant_get(payload, '$.firmware.v[1]', 'int') AS v"
    ).first()
    assert json.loads(row.raw_json)["firmware"] == {"v": [1, 2]} and row.v == 2


def test_the_load_time_is_one_value(spark):
    good, _ = split(spark, line(), line(badge_id="B2"))
    assert {r.ingestion_time for r in good} == {LOAD}


def test_json_round_trip_equals_the_typed_feed(feeds):
    """Writing the feed as JSON and reading it back gives the typed rows."""
    typed = parse_events(feeds.json_lines().select("value"), LOAD)
    columns = [c for c in typed.columns if c not in ("ingestion_time", "raw_json")]
    left, right = typed.select(*columns), feeds.raw.select(*columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
