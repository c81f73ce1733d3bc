"""The dashboard totals kept up to date from the change log.

A stream over the stored change log keeps, per (store, zone), running totals in
value state and, in map state, the last row of every window that may still be
corrected. A correction adds its difference, so a batch costs what it changes.
An event-time timer drops a window's row once its corrections have ended, which
bounds the state by the open windows; the totals stay. Every batch emits the
places it changed; the three dashboards are sums over one row per place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from footfall.operators.changelog import BATCH_ID, RUN
from footfall.sinks.tables import CHANGELOG, batch_partition_path, run_of

PLACE_KEY = ["store_id", "zone_id"]
PLACES = "store_id string, zone_id string, visitor_count long, total_dwell_time double, active_windows long, newest_ms long, newest_visitors long"


class PlaceTotals(StatefulProcessor):
    """Totals of one (store, zone); see the module."""

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start_ms long", "end_ms long, visitors long, dwell double, run string, batch long")
        self.totals = handle.getValueState("totals", "visitors long, dwell double, windows long, newest_ms long, newest_visitors long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        visitors, dwell, windows, newest, newest_visitors = self.totals.get() or (0, 0.0, 0, -1, 0)
        for batch in rows:
            for r in batch.itertuples(index=False):
                start, end = int(r.start_ms), int(r.end_ms)
                held = self.open.getValue((start,)) if self.open.exists() and self.open.containsKey((start,)) else None
                if held and (held[3], held[4]) >= (r.run, r.batch_id):
                    continue  # a later row of this window has been counted
                visitors += int(r.visitor_count) - (held[1] if held else 0)
                dwell += float(r.total_dwell_time) - (held[2] if held else 0.0)
                windows += 0 if held else 1
                if start >= newest:
                    newest, newest_visitors = start, int(r.visitor_count)
                self.open.updateValue((start,), (end, int(r.visitor_count), float(r.total_dwell_time), r.run, int(r.batch_id)))
                if not held:
                    self.handle.registerTimer(end)
        self.totals.update((visitors, dwell, windows, newest, newest_visitors))
        yield pd.DataFrame([(*key, visitors, dwell, windows, newest, newest_visitors)], columns=[c.split()[0] for c in PLACES.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        for start in [k[0] for k, v in self.open.iterator() if v[0] <= until]:
            self.open.removeKey((start,))
        yield from ()

    def close(self) -> None:
        pass


def changelog_stream(spark: SparkSession, path: str) -> DataFrame:
    """The stored change log as a stream, with ``run`` and ``batch_id``."""
    return spark.readStream.schema(CHANGELOG).parquet(path)


def place_totals(changelog: DataFrame, corrections_end: str) -> DataFrame:
    """Totals per (store, zone), emitted by every batch that changes them.

    ``corrections_end`` is how long after its end a window may still change: at
    least the watermark delay plus the window length of the traffic stream.
    A change-log row that comes after that is dropped as late."""
    rows = changelog.withWatermark("window_end", corrections_end).select(
        *PLACE_KEY, "window_end", F.unix_millis("window_start").alias("start_ms"), F.unix_millis("window_end").alias("end_ms"),
        "visitor_count", "total_dwell_time", RUN, BATCH_ID,
    )
    return rows.groupBy(*PLACE_KEY).transformWithStateInPandas(
        statefulProcessor=PlaceTotals(), outputStructType=PLACES, outputMode="Update", timeMode="EventTime"
    )


def places_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: each batch owns, and replaces, a folder."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_partition_path(path, batch_id, run_of(batch, path)))

    return sink


def read_places(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """The current row of every place, or the one after batch ``until``."""
    rows = spark.read.schema(f"{PLACES}, run string, batch_id long").parquet(path)
    if until is not None:
        rows = rows.filter(F.col(BATCH_ID) <= until)
    row = F.struct("visitor_count", "total_dwell_time", "active_windows", "newest_ms", "newest_visitors")
    return rows.groupBy(*PLACE_KEY).agg(F.max_by(row, F.struct(RUN, BATCH_ID)).alias("_row")).select(*PLACE_KEY, "_row.*")


def live_visitors_now(places: DataFrame) -> DataFrame:
    """Visitors over all stores in the newest window."""
    newest = places.select(F.max("newest_ms")).scalar()
    held = places.filter(F.col("newest_ms") == newest)
    return held.groupBy(F.timestamp_millis("newest_ms").alias("window_start")).agg(
        F.sum("newest_visitors").alias("visitor_count"), F.count(F.lit(1)).alias("active_zones")
    )


def store_performance_now(places: DataFrame) -> DataFrame:
    """Visitor volume, dwell and windows with visitors per store."""
    return places.groupBy("store_id").agg(
        F.sum("visitor_count").alias("visitor_count"),
        F.sum("total_dwell_time").alias("total_dwell_time"),
        F.sum("active_windows").alias("active_windows"),
    )


def zone_share_now(places: DataFrame) -> DataFrame:
    """Each (store, zone)'s share of all visitors."""
    total = places.select(F.sum("visitor_count")).scalar()
    return places.select(*PLACE_KEY, "visitor_count", (F.col("visitor_count") / total).alias("share"))
