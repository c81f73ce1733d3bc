import datetime as dt

from pyspark.sql import functions as F

from footfall.operators.aggregate import aggregate_traffic
from footfall.operators.changelog import changelog_by_batch, latest_by_count, latest_per_key
from footfall.operators.serving import live_visitors, store_performance, zone_share

SCHEMA = "batch_id long, event_time timestamp, store_id string, zone_id string, dwell_time_seconds double"


def t(h, m):
    return dt.datetime(2024, 1, 1, h, m, tzinfo=dt.timezone.utc)


def fixture(spark):
    rows = [
        (0, t(10, 1), "S1", "A", 1.0), (0, t(10, 2), "S1", "A", 2.0), (0, t(10, 3), "S2", "B", 4.0),
        (1, t(10, 4), "S1", "A", 8.0), (1, t(10, 6), "S1", "A", 16.0),
        (2, t(10, 7), "S2", "B", 32.0), (2, t(10, 8), "S1", "B", 64.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_changelog_running_totals(spark):
    log = changelog_by_batch(fixture(spark))
    got = as_set(log.withColumn("m", F.minute("window_start")),
                 ["batch_id", "m", "store_id", "zone_id", "visitor_count", "total_dwell_time"])
    assert got == {
        (0, 0, "S1", "A", 2, 3.0), (0, 0, "S2", "B", 1, 4.0),
        (1, 0, "S1", "A", 3, 11.0), (1, 5, "S1", "A", 1, 16.0),
        (2, 5, "S2", "B", 1, 32.0), (2, 5, "S1", "B", 1, 64.0),
    }


def test_raw_changelog_overcounts_latest_does_not(spark):
    ev = fixture(spark)
    log = changelog_by_batch(ev)
    raw = log.agg(F.sum("visitor_count")).first()[0]
    assert raw == 9 and ev.count() == 7
    cols = ["window_start", "store_id", "zone_id", "visitor_count", "total_dwell_time"]
    truth = as_set(aggregate_traffic(ev), cols)
    assert as_set(latest_per_key(log), cols) == truth
    assert as_set(latest_by_count(log.drop("batch_id")), cols) == truth


def test_serving_queries(spark):
    latest = aggregate_traffic(fixture(spark))
    lv = live_visitors(latest).first()
    assert (lv.window_start.minute, lv.visitor_count, lv.active_zones) == (5, 3, 3)
    sp = [(r.store_id, r.visitor_count) for r in store_performance(latest).collect()]
    assert sp == [("S1", 5), ("S2", 2)]
    zs = {(r.store_id, r.zone_id): r.share for r in zone_share(latest).collect()}
    assert zs == {("S1", "A"): 4 / 7, ("S2", "B"): 2 / 7, ("S1", "B"): 1 / 7}


def test_traffic_view_over_stored_changelog(spark):
    import os

    from footfall.session import scratch_path
    from footfall.sinks.tables import register_traffic_view, write_changelog

    path = os.path.join(scratch_path(spark, "t_view"), "cl")
    write_changelog(changelog_by_batch(fixture(spark)), path)
    view = register_traffic_view(spark, path, "traffic_stats_test")
    assert view.columns == ["window_start", "window_end", "store_id", "zone_id",
                            "visitor_count", "total_dwell_time"]
    top = spark.sql("SELECT store_id, sum(visitor_count) AS v FROM traffic_stats_test "
                    "GROUP BY store_id ORDER BY v DESC").collect()
    assert [(r.store_id, r.v) for r in top] == [("S1", 5), ("S2", 2)]


def test_dashboard_sql_matches_dataframe_versions(spark):
    from footfall.operators.serving import dashboard_sql

    latest = aggregate_traffic(fixture(spark))
    latest.createOrReplaceTempView("traffic_stats_sql_test")
    for name, fn in [("live_visitors", live_visitors), ("store_performance", store_performance),
                     ("zone_share", zone_share)]:
        via_sql = [tuple(r) for r in spark.sql(dashboard_sql(name, "traffic_stats_sql_test")).collect()]
        via_df = [tuple(r) for r in fn(latest).collect()]
        assert via_sql == via_df, name
