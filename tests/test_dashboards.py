"""Totals per place: corrections, rows delivered twice, and bounded state."""

import datetime as dt
import os

from footfall.schemas import TRAFFIC_STATS
from footfall.session import scratch_path
from footfall.sinks.tables import write_changelog_batch
from footfall.streaming.dashboards import changelog_stream, live_visitors_now, place_totals, places_writer, read_places, zone_share_now
from footfall.streaming.traffic import run_query

DAY = dt.datetime(2033, 2, 3)


def window(minute, zone, visitors, dwell):
    start = DAY + dt.timedelta(minutes=minute)
    return (start, start + dt.timedelta(minutes=5), "S", zone, visitors, dwell)


def test_totals_follow_corrections_and_state_is_evicted(spark):
    root = scratch_path(spark, "t_dashboards")
    log, places, checkpoint = (os.path.join(root, k) for k in ("log", "places", "checkpoint"))

    def batch(n, rows):
        write_changelog_batch(spark.createDataFrame(rows, TRAFFIC_STATS).coalesce(1), n, log)
        totals = place_totals(changelog_stream(spark, log), "15 minutes")
        run_query(spark, totals, places_writer(places), checkpoint, state_partitions=2, evict_at_end=True)
        return {r.zone_id: (r.visitor_count, r.total_dwell_time, r.active_windows, r.newest_visitors) for r in read_places(spark, places).collect()}

    def open_windows():
        held = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
        return held.count()

    assert batch(0, [window(0, "A", 2, 4.0), window(5, "A", 1, 1.0), window(0, "B", 3, 9.0)]) == {
        "A": (3, 5.0, 2, 1), "B": (3, 9.0, 1, 3)}
    assert open_windows() == 3
    # Window 0 of A is corrected, a window is new; B stays as it is.
    assert batch(1, [window(0, "A", 5, 6.5), window(10, "A", 4, 2.0)]) == {"A": (10, 9.5, 3, 4), "B": (3, 9.0, 1, 3)}
    assert live_visitors_now(read_places(spark, places)).first().asDict()["visitor_count"] == 4
    assert {r.zone_id: r.share for r in zone_share_now(read_places(spark, places)).collect()} == {"A": 10 / 13, "B": 3 / 13}
    assert {r.visitor_count for r in read_places(spark, places, until=0).collect()} == {3}
    # The batch is written again: its rows come a second time and count once.
    assert batch(1, [window(0, "A", 5, 6.5), window(10, "A", 4, 2.0)])["A"] == (10, 9.5, 3, 4)
    # An hour later all corrections have ended: only the new window is held, the totals stay.
    assert batch(2, [window(70, "B", 1, 1.0)]) == {"A": (10, 9.5, 3, 4), "B": (4, 10.0, 2, 1)}
    assert open_windows() == 1
