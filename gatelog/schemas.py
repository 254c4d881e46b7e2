"""Declared table schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
NTZ, DATE = T.TimestampNTZType(), T.DateType()
SIGNAL = T.DecimalType(5, 2)
COORDINATE = T.DecimalType(10, 6)
CREDITS = T.DecimalType(18, 6)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


REQUIRED = ("badge_id", "user_id", "zone_id", "reader_id", "event_timestamp")
MAX_ID_LENGTH = 50
MAX_DIRECTION_LENGTH = 10

RAW = _struct(
    badge_id=STRING, user_id=STRING, zone_id=STRING, reader_id=STRING, event_timestamp=NTZ,
    signal_strength=SIGNAL, signal_quality=STRING, direction=STRING, ingestion_time=NTZ,
    raw_json=STRING,
)
STAGED_COLUMNS = [name for name in RAW.names if name != "raw_json"]
STAGING = T.StructType(
    [RAW[name] for name in STAGED_COLUMNS] + [T.StructField("staging_time", NTZ)]
)
USERS = _struct(
    user_key=LONG, user_id=STRING, user_name=STRING, user_type=STRING, department=STRING,
    email=STRING, phone=STRING, clearance_level=STRING, is_active=BOOL,
    effective_start_date=NTZ, effective_end_date=NTZ, is_current=BOOL,
    created_timestamp=NTZ, updated_timestamp=NTZ,
)
ZONES = _struct(
    zone_key=LONG, zone_id=STRING, reader_id=STRING, building_name=STRING, floor_number=INT,
    zone_name=STRING, zone_type=STRING, capacity=LONG, requires_clearance=STRING,
    is_monitored=BOOL, is_restricted=BOOL, reader_location=STRING, reader_type=STRING,
    latitude=COORDINATE, longitude=COORDINATE, created_timestamp=NTZ, updated_timestamp=NTZ,
)
READERS = _struct(
    reader_key=LONG, reader_id=STRING, reader_name=STRING, reader_type=STRING,
    manufacturer=STRING, model=STRING, firmware_version=STRING, is_online=BOOL,
    last_heartbeat=NTZ, created_timestamp=NTZ, updated_timestamp=NTZ,
)
FACTS = _struct(
    event_key=LONG, user_key=LONG, zone_key=LONG, badge_id=STRING, reader_id=STRING,
    event_timestamp=NTZ, event_date=DATE, event_hour=INT, event_day_of_week=INT,
    direction=STRING, signal_strength=SIGNAL, signal_quality=STRING,
    is_restricted_access=BOOL, is_after_hours=BOOL, is_weekend=BOOL, ingestion_time=NTZ,
    fact_load_time=NTZ,
)
BATCH_LOG = _struct(
    name=STRING, database_name=STRING, state=STRING, scheduled_time=NTZ, completed_time=NTZ,
    error_code=STRING, error_message=STRING, rows_processed=LONG, batch_id=LONG,
    error_count=LONG, bytes_processed=LONG, max_event_key=LONG, run_id=STRING,
    rows_received=LONG,
)
# What each load added to a layer: merged, they are the layer's totals.
TOTALS = _struct(layer=STRING, load_time=NTZ, row_count=LONG, newest_event=NTZ)
# Telemetry that the platform exports; empty until it does.
PRUNING = _struct(
    table_name=STRING, interval_start_time=NTZ, num_queries=LONG, partitions_scanned=LONG,
    partitions_pruned=LONG, rows_scanned=LONG, rows_pruned=LONG,
)
METERING = _struct(
    warehouse_name=STRING, start_time=NTZ, end_time=NTZ, credits_used=CREDITS,
    credits_used_compute=CREDITS,
)
STORAGE = _struct(
    table_catalog=STRING, table_schema=STRING, table_name=STRING, active_bytes=LONG,
    time_travel_bytes=LONG, failsafe_bytes=LONG,
)
QUERIES = _struct(
    query_id=LONG, user_name=STRING, database_name=STRING, execution_status=STRING,
    start_time=NTZ, total_elapsed_ms=LONG, bytes_scanned=LONG, partitions_scanned=LONG,
    partitions_total=LONG, query_text=STRING, client_ip=STRING, event_type=STRING,
)
TELEMETRY = {"pruning": PRUNING, "metering": METERING, "storage": STORAGE, "queries": QUERIES}
RUN_METADATA = _struct(deployment_timestamp=NTZ, account_identifier=STRING, expires_date=DATE)
