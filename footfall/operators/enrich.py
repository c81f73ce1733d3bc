"""Event time, time-of-day flags and dimension enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.fixed import PEAK_END_HOUR, PEAK_START_HOUR
from footfall.functions.time import event_time_from_millis, in_hour_range, is_weekend, known_zone, local_time
from footfall.operators.joins import one_row_per_key, salted_left_join
from footfall.sources.dimensions import DEFAULT_TZ


def with_event_time(df: DataFrame, ms_col: str = "timestamp", out_col: str = "event_time") -> DataFrame:
    """Add the event time (TIMESTAMP) from epoch milliseconds; NULL when the
    value is missing or outside the timestamp range."""
    return df.withColumn(out_col, event_time_from_millis(ms_col))


def enrich_with_time_flags(
    df: DataFrame,
    peak_start: int = PEAK_START_HOUR,
    peak_end: int = PEAK_END_HOUR,
    time_col: str | None = None,
) -> DataFrame:
    """Add ``is_peak_hour`` and ``is_weekend`` (UTC). Uses ``time_col`` when
    given, else derives the time from ``timestamp`` (epoch ms); a missing
    time gives False for both flags."""
    ts = F.col(time_col) if time_col else event_time_from_millis("timestamp")
    return df.withColumn("is_peak_hour", in_hour_range(ts, peak_start, peak_end)).withColumn(
        "is_weekend", is_weekend(ts)
    )


def _lookup(events: DataFrame, dim: DataFrame, keys: list[str], salted: bool) -> DataFrame:
    dim = one_row_per_key(dim, keys)
    return salted_left_join(events, dim, keys) if salted else events.join(dim, on=keys, how="left")


def join_dimensions(
    events: DataFrame,
    stores: DataFrame | None = None,
    zones: DataFrame | None = None,
    store_cols: list[str] | None = None,
    zone_cols: list[str] | None = None,
    salted: bool = False,
) -> DataFrame:
    """Left-join store and zone attributes onto events. Unmatched events are
    kept with NULL attributes; a key that repeats in a dimension counts once.
    Spark chooses the join by the dimension's bytes and splits hot keys itself
    in batch plans. ``salted`` spreads them in a streaming plan whose dimension
    is too large to broadcast."""
    out = events
    if zones is not None:
        cols = zone_cols or ["zone_name", "product_category"]
        z = zones.select("store_id", "zone_id", *cols)
        out = _lookup(out, z, ["store_id", "zone_id"], salted)
    if stores is not None:
        cols = store_cols or ["store_name", "tz"]
        s = stores.select("store_id", *cols)
        out = _lookup(out, s, ["store_id"], salted)
    return out


def with_local_time_flags(
    df: DataFrame,
    stores: DataFrame,
    time_col: str = "event_time",
    peak_start: int = PEAK_START_HOUR,
    peak_end: int = PEAK_END_HOUR,
    salted: bool = False,
) -> DataFrame:
    """Peak-hour and weekend flags in each store's own time zone (``tz`` of
    the store dimension; stores without a row fall back to UTC). Adds
    ``tz``, ``local_time`` (store wall clock), ``is_peak_hour_local`` and
    ``is_weekend_local``."""
    s = stores.select("store_id", F.when(known_zone("tz"), F.col("tz")).alias("_store_tz"))
    joined = _lookup(df, s, ["store_id"], salted)
    tz = F.coalesce(F.col("_store_tz"), F.lit(DEFAULT_TZ))
    lt = local_time(F.col(time_col), tz)
    return (
        joined.withColumn("tz", tz)
        .withColumn("local_time", lt)
        .withColumn("is_peak_hour_local", in_hour_range("local_time", peak_start, peak_end))
        .withColumn("is_weekend_local", is_weekend("local_time"))
        .drop("_store_tz")
    )
