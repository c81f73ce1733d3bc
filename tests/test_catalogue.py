"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan-shape checks that matter at scale."""

import datetime as dt
import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

from __spark_entry__ import entry
from footfall.plans import catalogue as queries
from footfall.plans import oracle_queries as oracle_sql
from footfall.plans.catalogue import q07_traffic_stats, q13_zone_share, q14_dim_enriched

TABLES = ["region", "nation", "customer", "events"]
STREAMED = {"q17_stream_traffic", "q20_late_data", "q22_closed_windows", "q28_dead_letters", "q29_stream_changelog", "q30_intake_table", "q31_intake_traffic"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "store_id", "zone_id",
                          "visitor_count", "total_dwell_time"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMED))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, res.fetchall())


@pytest.mark.parametrize("name", sorted(STREAMED))
def test_streamed_query_matches(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, res.fetchall())


def results(duck, sql):
    res = duck.execute(sql)
    return canon([d[0] for d in res.description], res.fetchall())


def test_streamed_entries_tell_wrong_streams(duck):
    """What a stream would give that lost its state at every batch, or took
    late rows, differs from what the entries are held against."""
    right = oracle_sql()["q29_stream_changelog"]
    reset = right.replace("UNBOUNDED PRECEDING", "CURRENT ROW")
    assert reset != right and results(duck, reset) != results(duck, right)
    keys = {(r[0], r[1]) for r in duck.execute(f"SELECT window_start, store_id || zone_id FROM ({right})").fetchall()}
    assert len(results(duck, right)) > 1.5 * len(keys)  # keys are updated by several batches
    right = oracle_sql()["q20_late_data"]
    late = right.replace("> (SELECT max(event_time) FROM c) - INTERVAL 10 MINUTE", "IS NOT NULL")
    assert late != right and results(duck, late) != results(duck, right)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_partial_aggregate_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(q07_traffic_stats(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_dimension_plan_broadcasts(spark):
    plan = plan_of(q14_dim_enriched(spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_serving_totals_avoid_single_partition_window(spark):
    plan = plan_of(q13_zone_share(spark, SF_SMALL))
    assert "SinglePartition" not in plan.split("Subquery")[0]


def test_non_utc_session_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = queries()["q06_enrich_flags"](spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    duck_rows = duckdb.connect().execute(
        oracle_sql()["q06_enrich_flags"].replace(
            "FROM events e", f"FROM read_parquet('{SF_SMALL}/events.parquet') e")
    ).fetchall()
    assert sorted(r.is_peak_hour for r in rows) == sorted(r[8] for r in duck_rows)


def test_results_independent_of_input_layout(spark):
    """The events table re-written as 7 files (parallel scans, as on a
    cluster) and 3 shuffle partitions gives the same results."""
    from footfall.session import scratch_path

    split_dir = scratch_path(spark, "t_layout")
    spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).repartition(7).write.parquet(
        os.path.join(split_dir, "events.parquet"))
    names = ["q04_reject_events", "q07_traffic_stats", "q10_latest_stats", "q16_quality_profile"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        split = {n: canon(queries()[n](spark, split_dir).columns,
                          [tuple(r) for r in queries()[n](spark, split_dir).collect()]) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for n in names:
        df = queries()[n](spark, SF_SMALL)
        assert split[n] == canon(df.columns, [tuple(r) for r in df.collect()]), n
