"""Schemas of the sensor-traffic data model.

Every field is nullable: the message bus carries untrusted JSON and the
cleaning operators, not the schema, decide what is usable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Name of the column that receives the raw text of a payload that did not
# parse against SENSOR_EVENT (JSON syntax error or a type mismatch).
CORRUPT_COLUMN = "_corrupt_record"

# The fixed sensor-event schema. Unknown keys in a payload (for example a
# face id) are dropped at parse time: the schema is also the privacy rule.
SENSOR_EVENT = StructType(
    [
        StructField("event_id", StringType()),
        StructField("timestamp", LongType()),  # epoch milliseconds
        StructField("store_id", StringType()),
        StructField("zone_id", StringType()),
        StructField("sensor_id", StringType()),
        StructField("age_range", StringType()),
        StructField("gender", StringType()),
        StructField("dwell_time_seconds", DoubleType()),
    ]
)

SENSOR_EVENT_FIELDS = [f.name for f in SENSOR_EVENT.fields]

# Parse schema: the event schema plus the corrupt-record capture column.
SENSOR_EVENT_PARSE = StructType(
    SENSOR_EVENT.fields + [StructField(CORRUPT_COLUMN, StringType())]
)

# Windowed traffic result ("traffic_stats"), partitioned by store and zone.
TRAFFIC_STATS = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("store_id", StringType()),
        StructField("zone_id", StringType()),
        StructField("visitor_count", LongType()),
        StructField("total_dwell_time", DoubleType()),
    ]
)

TRAFFIC_KEY = ["window_start", "window_end", "store_id", "zone_id"]

# Dimension tables. `tz` is an IANA zone name used for store-local flags.
STORES = StructType(
    [
        StructField("store_id", StringType()),
        StructField("store_name", StringType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
        StructField("tz", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

ZONES = StructType(
    [
        StructField("zone_id", StringType()),
        StructField("store_id", StringType()),
        StructField("zone_name", StringType()),
        StructField("product_category", StringType()),
        StructField("area_sqm", DecimalType(10, 2)),
        StructField("created_at", TimestampType()),
    ]
)

# Intake table: every bus record parsed once. Event fields are null and the
# payload is kept where a record was rejected.
INTAKE = StructType(
    SENSOR_EVENT.fields
    + [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("bus_time", TimestampType()),
        StructField("reject_reason", StringType()),
        StructField("payload", StringType()),
        StructField("unparsed", BooleanType()),
        StructField("rejected", BooleanType()),
    ]
)

# Message-bus envelope, the same shape a Kafka source produces.
ENVELOPE = StructType(
    [
        StructField("topic", StringType()),
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)
