"""The clustered table: nothing lost, few files read, the curve's numbers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_catalogue import SF_SMALL

from footfall.plans.catalogue import traffic_current
from footfall.session import scratch_path
from footfall.sinks.clustered import expire_versions, file_index, interleaved, newest_window, pruned_files, read_clustered, write_clustered


@pytest.fixture(scope="module")
def table(spark):
    rows = traffic_current(spark, SF_SMALL).persist()
    path = os.path.join(scratch_path(spark, "t_clustered"), "table")
    write_clustered(rows, path, rows_per_file=max(1, rows.count() // 64))
    return rows, path


def test_curve_interleaves_bits(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    rows = spark.createDataFrame(pairs, "a long, b long").withColumn("z", interleaved([F.col("a"), F.col("b")], bits=3)).collect()
    for r in rows:
        a, b = f"{r.a:03b}", f"{r.b:03b}"
        assert r.z == int("".join(x + y for x, y in zip(a, b)), 2)


def test_nothing_is_lost(spark, table):
    rows, path = table
    held = read_clustered(spark, path)
    assert held.count() == rows.count() and held.exceptAll(rows.select(*held.columns)).isEmpty()
    assert file_index(spark, path).agg(F.sum("n_rows")).first()[0] == rows.count()


def test_dashboards_open_few_files(spark, table):
    """The newest window lies in a small share of the files."""
    _, path = table
    total = file_index(spark, path).count()
    newest = newest_window(spark, path)
    live = pruned_files(spark, path, since=newest)
    assert total >= 32 and 1 <= len(live) <= total // 8


def test_store_and_time_prune_together(spark, table):
    rows, path = table
    total, newest = file_index(spark, path).count(), newest_window(spark, path)
    since = newest - dt.timedelta(days=7)
    files = pruned_files(spark, path, {"store_id": "STORE_01"}, since)
    assert 1 <= len(files) <= total // 4
    got = read_clustered(spark, path, {"store_id": "STORE_01"}, since)
    want = rows.filter((F.col("store_id") == "STORE_01") & (F.col("window_start") >= F.lit(since)))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).isEmpty()


def test_readers_see_the_newest_complete_version(spark, table):
    rows, _ = table
    path = os.path.join(scratch_path(spark, "t_clustered_again"), "table")
    for n in (3, 5, 7):
        write_clustered(rows.limit(n), path, rows_per_file=2)
    spark.range(3).write.parquet(os.path.join(path, "version=9999999999999-unfinished"))
    assert read_clustered(spark, path).count() == 7
    assert len(expire_versions(spark, path, keep=1)) == 2 and read_clustered(spark, path).count() == 7


def test_empty_table(spark, table):
    rows, _ = table
    path = os.path.join(scratch_path(spark, "t_clustered_empty"), "table")
    write_clustered(rows.limit(0), path)
    assert newest_window(spark, path) is None and read_clustered(spark, path).count() == 0
