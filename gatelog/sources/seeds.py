"""Initial dimension rows."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gatelog import schemas

# user_id, user_name, user_type, department, clearance_level.
USER_ROWS = [
    ("USR-001", "John Smith", "EMPLOYEE", "Engineering", "CONFIDENTIAL"),
    ("USR-002", "Jane Doe", "EMPLOYEE", "HR", "PUBLIC"),
    ("USR-003", "Bob Johnson", "CONTRACTOR", "IT Support", "PUBLIC"),
    ("USR-004", "Alice Williams", "EMPLOYEE", "Security", "SECRET"),
    ("USR-005", "Mike Davis", "VISITOR", "External", "PUBLIC"),
]

# zone_id, reader_id, building_name, floor_number, zone_name, zone_type,
# capacity, requires_clearance, is_restricted, reader_location, reader_type.
ZONE_ROWS = [
    ("ZONE-LOBBY-1", "RDR-101", "Main Building", 1, "Main Lobby", "LOBBY",
     100, None, False, "Main Entrance", "BIDIRECTIONAL"),
    ("ZONE-OFFICE-2A", "RDR-201", "Main Building", 2, "Engineering Office 2A", "OFFICE",
     30, "CONFIDENTIAL", True, "Floor 2 East", "ENTRY"),
    ("ZONE-SERVER-B1", "RDR-B101", "Main Building", -1, "Server Room B1", "SECURE_AREA",
     5, "SECRET", True, "Basement Security Door", "BIDIRECTIONAL"),
    ("ZONE-CONF-3B", "RDR-301", "Main Building", 3, "Conference Room 3B", "CONFERENCE_ROOM",
     20, None, False, "Floor 3 West", "ENTRY"),
    ("ZONE-PARKING-1", "RDR-P01", "Parking Structure", 1, "Employee Parking Level 1",
     "PARKING", 200, None, False, "Garage Entry", "ENTRY"),
]


def _arrow(dtype: T.DataType) -> pa.DataType:
    if isinstance(dtype, T.DecimalType):
        return pa.decimal128(dtype.precision, dtype.scale)
    return {
        T.StringType(): pa.string(),
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.BooleanType(): pa.bool_(),
        T.TimestampNTZType(): pa.timestamp("us"),
        T.DateType(): pa.date32(),
    }[dtype]


def local_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A small literal table. Arrow input gives the optimizer its true size.

    Columns a row does not name are null.
    """
    columns = pa.schema([(field.name, _arrow(field.dataType)) for field in schema])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=columns), schema)


def seed_users(spark: SparkSession, load_ts: datetime) -> DataFrame:
    columns = ("user_id", "user_name", "user_type", "department", "clearance_level")
    rows = [
        {
            "user_key": key,
            **dict(zip(columns, row, strict=True)),
            "is_active": True,
            "effective_start_date": load_ts,
            "is_current": True,
            "created_timestamp": load_ts,
            "updated_timestamp": load_ts,
        }
        for key, row in enumerate(USER_ROWS, start=1)
    ]
    return local_table(spark, rows, schemas.USERS)


def seed_zones(spark: SparkSession, load_ts: datetime) -> DataFrame:
    columns = (
        "zone_id", "reader_id", "building_name", "floor_number", "zone_name", "zone_type",
        "capacity", "requires_clearance", "is_restricted", "reader_location", "reader_type",
    )
    rows = [
        {
            "zone_key": key,
            **dict(zip(columns, row, strict=True)),
            "is_monitored": True,
            "created_timestamp": load_ts,
            "updated_timestamp": load_ts,
        }
        for key, row in enumerate(ZONE_ROWS, start=1)
    ]
    return local_table(spark, rows, schemas.ZONES)


def empty_readers(spark: SparkSession) -> DataFrame:
    """The reader dimension is declared but starts without rows."""
    return spark.createDataFrame([], schemas.READERS)
