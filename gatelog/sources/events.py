"""JSON badge events: read, type, validate, quarantine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatelog import schemas
from gatelog.functions.labels import signal_quality
from gatelog.functions.times import ntz

# Fixed value: accepted ISO 8601 forms (plain, fractional, Z, ±hh:mm).
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$"
MISSING_SIGNAL = -999

_FIELDS = (
    "badge_id", "user_id", "zone_id", "reader_id", "event_timestamp", "signal_strength",
    "direction",
)
_ENVELOPE = ", ".join(f"{name} string" for name in (*_FIELDS, "_malformed"))


def read_events(spark: SparkSession, path: str, stream: bool = True, **options) -> DataFrame:
    """One JSON object per line, as ``value STRING``."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


def extract_fields(df: DataFrame) -> DataFrame:
    """Add the payload's fields as text columns, and ``_malformed`` with unreadable lines.

    Text keeps one bad field from nulling its neighbours: each one is cast, and
    rejected, on its own. Going through a generator makes the fields real columns;
    otherwise Spark would copy the JSON parse into every expression that uses one.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    event = F.from_json("value", _ENVELOPE, options)
    return df.select("*", F.inline(F.array(event)))


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 text to wall-clock time; the offset is dropped, other forms give null."""
    return F.when(text.rlike(ISO_TIMESTAMP), text.try_cast("timestamp_ntz"))


def whole_signal(text: Column) -> Column:
    """A number without declared scale rounds half-up to an integer."""
    return text.try_cast("decimal(38,0)")


def reject_reasons() -> Column:
    """Comma-separated reasons for the columns of ``extract_fields``; '' if acceptable."""
    signal = whole_signal(F.col("signal_strength"))
    moment = iso_timestamp(F.col("event_timestamp"))
    checks = [(F.col(name).isNull(), f"missing_{name}") for name in schemas.REQUIRED]
    for name in schemas.REQUIRED[:-1]:
        checks.append((F.length(name) > schemas.MAX_ID_LENGTH, f"too_long_{name}"))
    checks += [
        (F.col("event_timestamp").isNotNull() & moment.isNull(), "bad_event_timestamp"),
        (F.col("signal_strength").isNotNull() & signal.isNull(), "bad_signal_strength"),
        (F.abs(signal) > 999, "signal_strength_out_of_range"),
        (F.length("direction") > schemas.MAX_DIRECTION_LENGTH, "too_long_direction"),
    ]
    found = F.concat_ws(",", *[F.when(condition, reason) for condition, reason in checks])
    malformed = F.col("_malformed").isNotNull() | (F.trim("value") == "")
    return F.when(malformed, "malformed_json").otherwise(found)


def _stamp(load_ts: datetime | None) -> Column:
    return ntz(load_ts) if load_ts else F.current_timestamp().cast("timestamp_ntz")


def classify_events(df: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """JSON lines as typed landing columns, matched by name, plus ``reject_reason``.

    Without ``load_ts`` the stamp is the micro-batch's own time, the same for all its
    rows. Fields that are not columns survive in ``raw_json``. A rejected line keeps what
    could be typed.
    """
    signal = whole_signal(F.col("signal_strength"))
    return extract_fields(df).select(
        "badge_id",
        "user_id",
        "zone_id",
        "reader_id",
        iso_timestamp(F.col("event_timestamp")).alias("event_timestamp"),
        F.coalesce(signal, F.lit(MISSING_SIGNAL))
        .try_cast(schemas.SIGNAL)
        .alias("signal_strength"),
        signal_quality(signal).alias("signal_quality"),
        F.upper("direction").alias("direction"),
        _stamp(load_ts).alias("ingestion_time"),
        F.col("value").alias("raw_json"),
        reject_reasons().alias("reject_reason"),
    )


def accepted(classified: DataFrame) -> DataFrame:
    """The typed rows of ``classify_events``."""
    return classified.filter("reject_reason = ''").select(*schemas.RAW.names)


def rejected(classified: DataFrame) -> DataFrame:
    """The quarantined lines of ``classify_events`` with their reasons."""
    return classified.filter("reject_reason <> ''").select(
        F.col("raw_json").alias("value"), "reject_reason", "ingestion_time"
    )


def validate_events(
    df: DataFrame, load_ts: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split JSON lines into (typed raw rows, quarantined lines with reasons)."""
    classified = classify_events(df, load_ts)
    return accepted(classified), rejected(classified)


def parse_events(df: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    """The typed rows of ``validate_events``."""
    return validate_events(df, load_ts)[0]


def with_variant(df: DataFrame, column: str = "raw_json") -> DataFrame:
    """Add the payload as VARIANT next to its text."""
    return df.withColumn("payload", F.try_parse_json(column))


@dataclass(frozen=True)
class Retries:
    """How a producer's resent lines are told: the payload's token, and the time that ends a row of copies.

    A line is a resend if an accepted line with its token arrived at most ``delay`` before it, a resend
    itself or not. Rejected lines and lines without token are none, and a line that follows a rejected
    one is none either.
    """

    path: str = "$.token"
    delay: timedelta = timedelta(hours=2)

    def tokens(self, classified: DataFrame) -> DataFrame:
        """The columns of ``classify_events``, with the token of accepted lines."""
        token = F.get_json_object("raw_json", self.path)
        return classified.withColumn(TOKEN, F.when(F.col("reject_reason") == "", token))


#: The column of ``Retries.tokens``.
TOKEN = "retry_token"


def first_sends(df: DataFrame, token: str, arrived: str, delay: timedelta) -> DataFrame:
    """One row of each row of copies: those of a token that arrive at most ``delay`` after one another.

    The earliest stays; of those that arrive at once the least by the other columns, in their order.
    Rows without token or arrival all stay. Copies within a span of ``delay`` are put together before
    the shuffle, so a token that is resent without end moves one row per span and task, and its window
    holds one row per span. The columns must be orderable.
    """
    span = _micros(delay)
    micros = F.unix_micros(F.col(arrived).cast("timestamp"))
    start = micros - F.pmod(micros, F.lit(span))
    others = [c for c in df.columns if c not in (token, arrived)]
    known = F.col(token).isNotNull() & F.col(arrived).isNotNull()
    spans = df.filter(known).groupBy(F.col(token).alias("_token"), start.alias("_span")).agg(
        F.min(F.struct(arrived, token, *others)).alias("_first"), F.max(arrived).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy("_token").orderBy("_span"))
    gap = F.make_dt_interval(secs=F.lit(span).cast("decimal(18,6)") / 1_000_000)
    kept = spans.withColumn("_before", before).filter(
        F.col("_before").isNull() | (F.col(f"_first.{arrived}") > F.col("_before") + gap))
    return kept.select("_first.*").select(*df.columns).unionByName(df.filter(~known))


def _micros(delay: timedelta) -> int:
    if delay <= timedelta(0):
        raise ValueError("the delay must be positive")
    return delay // timedelta(microseconds=1)


def _newest_copies(token: str, event_time: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.select([token, event_time]).to_pandas()
            newest = copies.sort_values(event_time, ascending=False, kind="stable")
            first = newest.drop_duplicates(token).index
            yield batch.take(pa.array(first, pa.int64()))

    return keep


def dedupe_retries(df: DataFrame, token: str, event_time: str, delay: timedelta) -> DataFrame:
    """Drop resent rows by producer token: ``first_sends``, or its like with state on a stream.

    A stream keeps one row of copies that all lie within ``delay`` of the first, as the batch form does;
    of a longer row it may let more pass, and it drops rows later than the watermark. Landing with
    ``Retries`` does neither. Spark's streaming duplicate check shuffles every copy to the task that owns
    the token; dropping copies inside each Arrow batch first keeps a token that is resent without end
    from swamping that task. The copy with the newest event time stays: if that one is too late for the
    watermark, so are all others, and no older copy decides when the token is forgotten.
    """
    if not df.isStreaming:
        return first_sends(df, token, event_time, delay)
    timed = df.mapInArrow(_newest_copies(token, event_time), df.schema).withColumn(
        "_event_time", F.col(event_time).cast("timestamp")
    )
    marked = timed.withWatermark("_event_time", f"{_micros(delay)} microseconds")
    return marked.dropDuplicatesWithinWatermark([token]).drop("_event_time")
