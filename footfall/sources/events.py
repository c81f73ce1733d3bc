"""Sensor events derived from the driver's ``events`` table.

The driver ships a generic click-stream table; this module maps every row
of it onto the sensor-event schema with a fixed, engine-independent rule so
the same view can be written in DuckDB SQL for the correctness oracle.
Every input row is kept. The rule deliberately produces dirty data the
cleaning operators must handle: missing store/zone ids, negative and
over-long dwell times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.fixed import AGE_RANGES, GENDERS
from footfall.session import ensure_utc
from footfall.sources.tables import read_table

# Values of this mapping (restated in the DuckDB oracle view).
STORE_COUNT = 3
ZONE_LETTERS = "ABCD"
MISSING_STORE_EVERY = 97  # event ids divisible by this carry no store id
MISSING_ZONE_EVERY = 89  # event ids divisible by this carry no zone id
ERROR_EVENT_TYPE = "error"  # sensor error frames report a negative dwell
DWELL_SCALE = 10.0  # value -> seconds for all other frames
SENSOR_ID_BASE = 1000


def _pick(values: list[str], index: Column) -> Column:
    """1-based lookup into a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _sensor_columns(ev: DataFrame) -> list[Column]:
    eid, uid = F.col("event_id"), F.col("user_id")
    return [
        eid.cast("string").alias("event_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(eid % MISSING_STORE_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("STORE_0"), (uid % STORE_COUNT + 1).cast("string")))
        .alias("store_id"),
        F.when(eid % MISSING_ZONE_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(
            F.concat(
                F.lit("ZONE_"),
                F.substring(F.lit(ZONE_LETTERS), (F.expr("user_id div 3") % 4 + 1).cast("int"), 1),
            )
        )
        .alias("zone_id"),
        F.concat(F.lit("SENSOR_"), (uid + SENSOR_ID_BASE).cast("string")).alias("sensor_id"),
        _pick(AGE_RANGES, uid % len(AGE_RANGES) + 1).alias("age_range"),
        _pick(GENDERS, eid % len(GENDERS) + 1).alias("gender"),
        F.when(F.col("event_type") == ERROR_EVENT_TYPE, -F.col("value"))
        .otherwise(F.col("value") * DWELL_SCALE)
        .alias("dwell_time_seconds"),
    ]


def sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensor-event view "S": 8 columns, one row per ``events`` row."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(*_sensor_columns(ev))


def sensor_events_with_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S plus ``offset`` (the source row id, used as a bus offset) and
    ``bus_time`` (arrival time on the bus)."""
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("bus_time"),
        *_sensor_columns(ev),
    )
