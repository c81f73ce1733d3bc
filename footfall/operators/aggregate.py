"""Windowed traffic aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.fixed import WINDOW_DURATION as DEFAULT_WINDOW


def aggregate_traffic(
    df: DataFrame,
    window_duration: str = DEFAULT_WINDOW,
    time_col: str = "event_time",
) -> DataFrame:
    """Events per tumbling, epoch-aligned event-time window and (store, zone):
    ``visitor_count`` counts events, ``total_dwell_time`` sums dwell seconds.

    Windows are start-inclusive, end-exclusive; rows without a time fall in
    no window. Works on bounded and streaming inputs (with a watermark on
    ``time_col`` the streaming state is evicted). The plan is a partial
    aggregate per input partition, one shuffle on the grouping key, and a
    final aggregate, so a hot store or zone costs one row per map task.
    """
    grouped = df.groupBy(
        F.window(F.col(time_col), window_duration).alias("window"),
        F.col("store_id"),
        F.col("zone_id"),
    ).agg(
        F.count(F.lit(1)).alias("visitor_count"),
        F.sum("dwell_time_seconds").alias("total_dwell_time"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "store_id",
        "zone_id",
        "visitor_count",
        "total_dwell_time",
    )


GRID = 1 << 32  # parts of a second to which exact sums hold a dwell time


def aggregate_traffic_exact(df: DataFrame, window_duration: str = DEFAULT_WINDOW, time_col: str = "event_time") -> DataFrame:
    """``aggregate_traffic`` whose ``total_dwell_time`` has the same bits however
    the events are partitioned, batched or retried.

    Each dwell time is cut to whole seconds and 2^-32 parts of one, both summed
    as whole numbers (exact in any order), and the total is rounded once. It lies
    at most ``visitor_count`` * 2^-32 s below the true sum. Whole numbers hold
    2^31 events a window and key; beyond that the sum raises instead of wrapping.
    NULL, NaN and infinite times are left out, as a sum leaves out NULL."""
    d = F.col("dwell_time_seconds")
    usable = F.when((d > -1e15) & (d < 1e15), d)
    whole = F.floor(usable)
    grouped = df.groupBy(F.window(F.col(time_col), window_duration).alias("window"), "store_id", "zone_id").agg(
        F.count(F.lit(1)).alias("visitor_count"),
        F.sum(whole).alias("_whole"),
        F.sum(F.floor((usable - whole) * GRID)).alias("_parts"),
    )
    carry = F.floor(F.col("_parts") / GRID)
    total = (F.col("_whole") + carry) + (F.col("_parts") - carry * GRID) / GRID
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "store_id", "zone_id",
        "visitor_count", total.alias("total_dwell_time"),
    )
