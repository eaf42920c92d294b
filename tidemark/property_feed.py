"""The property feed of the versioned-table workflow: columns, proposed types, keys.

Feeds without types (CSV, JSON) are read with :data:`DAILY_SCHEMA` or
:data:`HISTORY_SCHEMA`; columns are taken in file order, as the workflow does.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark.spec import TableSpec

# Column names of the daily property feed, in file order, and the
# two version columns the history feed adds after them.
DAILY_COLUMNS = (
    "property_id", "address", "covered_area", "owner_id", "last_sale_date", "create_date", "status_id",
    "status_desc", "price", "postal_zone", "zip_code", "city", "state", "country",
)
VERSION_COLUMNS = ("version", "version_time")
HISTORY_COLUMNS = DAILY_COLUMNS + VERSION_COLUMNS

# The workflow's default primary key, partition column and version column.
DEFAULT_PRIMARY_KEY = "property_id"
DEFAULT_PARTITION_KEY = "city"
DEFAULT_VERSION_KEY = "version"
# Fixed value: the column that stores the load time of the property feed's rows.
LOAD_TIME_COLUMN = "epoch_record_time"

# Our types (the workflow names columns only).  zip_code stays a string so that
# leading zeros survive.
_TYPES = {
    "property_id": LongType(), "address": StringType(), "covered_area": DoubleType(), "owner_id": LongType(),
    "last_sale_date": DateType(), "create_date": DateType(), "status_id": IntegerType(),
    "status_desc": StringType(), "price": DecimalType(18, 2), "postal_zone": StringType(),
    "zip_code": StringType(), "city": StringType(), "state": StringType(), "country": StringType(),
    "version": IntegerType(), "version_time": TimestampNTZType(),
}

DAILY_SCHEMA = StructType([StructField(c, _TYPES[c]) for c in DAILY_COLUMNS])
HISTORY_SCHEMA = StructType([StructField(c, _TYPES[c]) for c in HISTORY_COLUMNS])

# Newest first by version, then by version time.
PROPERTY_SPEC = TableSpec((DEFAULT_PRIMARY_KEY,), VERSION_COLUMNS, DEFAULT_PARTITION_KEY, LOAD_TIME_COLUMN)


def stored_schema(load_ts_col: str = LOAD_TIME_COLUMN) -> StructType:
    """Schema of *current* and *archive* loaded from the history feed: its columns plus the load time."""
    return StructType(HISTORY_SCHEMA.fields + [StructField(load_ts_col, TimestampNTZType())])
