from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gatelog.functions import labels, numbers, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("seconds", "text"),
    [(0, "0s"), (59, "59s"), (60, "1m 0s"), (303, "5m 3s"), (3599, "59m 59s"),
     (3600, "1h 0m"), (8070, "2h 14m"), (None, None)],
)
def test_humanized_seconds(spark, seconds, text):
    assert one(spark, labels.humanize_seconds(F.lit(seconds).cast("bigint"))) == text


@pytest.mark.parametrize(
    ("status", "color"),
    [("HEALTHY", "green"), ("WARNING", "orange"), ("STALE", "red"), ("SUCCESS", "green"),
     ("FAILED", "red"), ("SKIPPED", "gray"), ("other", "gray"), (None, "gray")],
)
def test_colors(spark, status, color):
    assert one(spark, labels.health_color(F.lit(status).cast("string"))) == color


@pytest.mark.parametrize(
    ("seconds", "band"),
    [(120, "HEALTHY"), (121, "WARNING"), (300, "WARNING"), (301, "STALE"), (None, "HEALTHY")],
)
def test_health_bands(spark, seconds, band):
    assert one(spark, labels.health_band(F.lit(seconds).cast("bigint"))) == band


def test_an_idle_layer_can_be_named(spark):
    assert one(spark, labels.health_band(F.lit(None).cast("bigint"), "IDLE")) == "IDLE"


@pytest.mark.parametrize(
    ("share", "band"),
    [(19.99, "EXCELLENT"), (20, "GOOD"), (50, "FAIR"), (80, "POOR"), (None, "POOR")],
)
def test_pruning_bands(spark, share, band):
    assert one(spark, labels.pruning_band(F.lit(share).cast("double"))) == band


@pytest.mark.parametrize(
    ("state", "status"),
    [("SUCCEEDED", "SUCCESS"), ("FAILED", "FAILED"), ("SKIPPED", "SKIPPED"),
     ("EXECUTING", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_execution_bands(spark, state, status):
    assert one(spark, labels.execution_band(F.lit(state).cast("string"))) == status


def test_seconds_count_boundaries(spark):
    start, end = datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000)
    assert one(spark, times.seconds_between(times.ntz(start), times.ntz(end))) == 1
    assert one(spark, times.seconds_between(times.ntz(end), times.ntz(start))) == -1


@pytest.mark.parametrize(
    ("hour", "after"), [(0, True), (5, True), (6, False), (21, False), (22, True), (23, True)]
)
def test_after_hours(spark, hour, after):
    assert one(spark, times.is_after_hours(times.ntz(datetime(2024, 1, 1, hour)))) is after


@pytest.mark.parametrize(
    ("day", "number", "weekend"),
    [(6, 6, True), (7, 0, True), (8, 1, False), (12, 5, False)],  # Saturday 6 January 2024
)
def test_days_of_week(spark, day, number, weekend):
    moment = times.ntz(datetime(2024, 1, day))
    assert one(spark, times.day_of_week(moment)) == number
    assert one(spark, times.is_weekend(moment)) is weekend


@pytest.mark.parametrize(
    ("a", "b", "result"), [(1, 3, 33.33), (1, 200, 0.5), (1, 800, 0.13), (5, 0, None), (0, 7, 0.0)]
)
def test_percentages_round_half_up(spark, a, b, result):
    assert one(spark, numbers.pct(F.lit(a), F.lit(b))) == result


def test_conditional_sum_over_no_rows_is_null(spark):
    row = spark.range(0).agg(
        numbers.sum_if(F.col("id") > 0).alias("s"), F.count_if(F.col("id") > 0).alias("c")
    ).first()
    assert (row.s, row.c) == (None, 0)


def test_truncation_keeps_wall_clock(spark):
    moment = times.ntz(datetime(2024, 3, 31, 2, 59, 59, 5))
    assert one(spark, times.truncate("hour", moment)) == datetime(2024, 3, 31, 2)
