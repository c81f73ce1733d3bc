"""Dashboard queries over the current traffic table (one row per key).

Totals use scalar subqueries (a distributed aggregate evaluated once), not
``sum() over ()``, which would pull every row into a single partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.aggregate import aggregate_traffic


def live_visitors(latest: DataFrame) -> DataFrame:
    """Visitors over all stores in the most recent window."""
    newest = latest.select(F.max("window_start")).scalar()
    return (
        latest.filter(F.col("window_start") == newest)
        .groupBy("window_start", "window_end")
        .agg(
            F.sum("visitor_count").alias("visitor_count"),
            F.count(F.lit(1)).alias("active_zones"),
        )
    )


def live_visitors_from_events(
    events: DataFrame, window_minutes: int = 5, time_col: str = "event_time"
) -> DataFrame:
    """``live_visitors`` straight from timed events, without aggregating every
    window: the newest window is the one holding the latest event time (a
    global max, partial per task), so only events from its start on are
    aggregated and shuffled."""
    width_ms = window_minutes * 60_000
    newest = events.select(F.max(time_col)).scalar()
    start = F.timestamp_millis(F.floor(F.unix_millis(newest) / width_ms) * width_ms)
    recent = events.filter(F.col(time_col) >= start)  # all of it lies in the newest window
    return (
        aggregate_traffic(recent, f"{window_minutes} minutes", time_col)
        .groupBy("window_start", "window_end")
        .agg(
            F.sum("visitor_count").alias("visitor_count"),
            F.count(F.lit(1)).alias("active_zones"),
        )
    )


def store_performance(latest: DataFrame) -> DataFrame:
    """Visitor volume and dwell per store, largest first."""
    return (
        latest.groupBy("store_id")
        .agg(
            F.sum("visitor_count").alias("visitor_count"),
            F.sum("total_dwell_time").alias("total_dwell_time"),
            F.count(F.lit(1)).alias("active_windows"),
        )
        .orderBy(F.desc("visitor_count"), "store_id")
    )


def zone_share(latest: DataFrame) -> DataFrame:
    """Each (store, zone)'s share of all visitors. The total is summed from
    the per-zone rows, so its subquery shares the aggregation's shuffle
    stages (reused, not recomputed)."""
    per_zone = latest.groupBy("store_id", "zone_id").agg(F.sum("visitor_count").alias("visitor_count"))
    total = per_zone.select(F.sum("visitor_count")).scalar()
    return per_zone.withColumn("share", F.col("visitor_count") / total).orderBy(
        F.desc("share"), "store_id", "zone_id"
    )


def zone_share_from_events(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """``zone_share`` straight from timed events: one partial row per task and
    zone is shuffled, instead of every window's."""
    counts = events.filter(F.col(time_col).isNotNull()).groupBy("store_id", "zone_id").agg(F.count(F.lit(1)).alias("visitor_count"))
    return zone_share(counts)


# The same dashboard questions as Spark SQL over a ``traffic_stats`` view
# (see ``footfall.sinks.register_traffic_view``), for SQL dashboards.
DASHBOARD_SQL = {
    "live_visitors": """
        SELECT window_start, window_end,
               sum(visitor_count) AS visitor_count, count(*) AS active_zones
        FROM {view}
        WHERE window_start = (SELECT max(window_start) FROM {view})
        GROUP BY window_start, window_end""",
    "store_performance": """
        SELECT store_id, sum(visitor_count) AS visitor_count,
               sum(total_dwell_time) AS total_dwell_time, count(*) AS active_windows
        FROM {view}
        GROUP BY store_id
        ORDER BY visitor_count DESC, store_id""",
    "zone_share": """
        WITH per_zone AS (
          SELECT store_id, zone_id, sum(visitor_count) AS visitor_count
          FROM {view} GROUP BY store_id, zone_id)
        SELECT store_id, zone_id, visitor_count,
               visitor_count / (SELECT sum(visitor_count) FROM per_zone) AS share
        FROM per_zone
        ORDER BY share DESC, store_id, zone_id""",
}


def dashboard_sql(name: str, view: str = "traffic_stats") -> str:
    """SQL text of one dashboard question over ``view``."""
    return DASHBOARD_SQL[name].format(view=view)
