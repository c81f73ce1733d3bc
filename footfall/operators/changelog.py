"""Change-log semantics of the windowed result table.

A streaming aggregate in ``update`` mode emits, per micro-batch, every
(window, store, zone) that changed, with its running totals. Appending those
rows gives a change log in which one key appears once per batch that touched
it. ``changelog_by_batch`` computes exactly that log for a bounded input cut
into ordered batches; ``latest_per_key`` recovers the current table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.aggregate import DEFAULT_WINDOW
from footfall.schemas import TRAFFIC_KEY

BATCH_ID = "batch_id"
RUN = "run"


def changelog_by_batch(
    events: DataFrame,
    batch_col: str = BATCH_ID,
    window_duration: str = DEFAULT_WINDOW,
    time_col: str = "event_time",
) -> DataFrame:
    """Update-mode output of a windowed aggregate over ordered batches.

    Events are first reduced to one row per (batch, window, store, zone);
    the running totals are then a window function over a key's few batch
    rows, partitioned by the key (no global ordering)."""
    per_batch = events.groupBy(
        F.col(batch_col).alias(BATCH_ID),
        F.window(F.col(time_col), window_duration).alias("window"),
        "store_id",
        "zone_id",
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("dwell_time_seconds").alias("dwell"),
    ).select(
        BATCH_ID,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "store_id",
        "zone_id",
        "n",
        "dwell",
    )
    running = (
        Window.partitionBy(*TRAFFIC_KEY)
        .orderBy(BATCH_ID)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_batch.select(
        BATCH_ID,
        *TRAFFIC_KEY,
        F.sum("n").over(running).alias("visitor_count"),
        F.sum("dwell").over(running).alias("total_dwell_time"),
    )


def latest_per_key(changelog: DataFrame, order_col: str = BATCH_ID) -> DataFrame:
    """Current state of each (window, store, zone): the row of its latest batch
    (of the latest run, where the log says which run wrote a batch)."""
    order = F.struct(RUN, BATCH_ID) if order_col == BATCH_ID and RUN in changelog.columns else F.col(order_col)
    latest = changelog.groupBy(*TRAFFIC_KEY).agg(
        F.max_by(F.struct("visitor_count", "total_dwell_time"), order).alias("s")
    )
    return latest.select(*TRAFFIC_KEY, "s.visitor_count", "s.total_dwell_time")


def latest_by_count(changelog: DataFrame) -> DataFrame:
    """For a change log without batch ids: the running count only grows while
    a window is open, so the row with the largest count is the latest."""
    return latest_per_key(changelog, order_col="visitor_count")
