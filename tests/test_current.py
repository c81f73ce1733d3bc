"""The folded current table and the table append."""

import os
from datetime import datetime

from footfall.plans.streamed import folded_table
from footfall.session import scratch_path
from footfall.sinks.current import current_dates, expire_folded, fold_changelog, read_current, read_newest_date
from footfall.sinks.tables import append_to_table, batch_partition_path, ensure_traffic_table, write_changelog_batch
from footfall.operators.serving import live_visitors
from conftest import SF_SMALL

D1, D2, D3 = (datetime(2031, 3, d, 11, 40) for d in (4, 5, 6))
ROW = "window_start timestamp, window_end timestamp, store_id string, zone_id string, visitor_count long, total_dwell_time double"


def put(spark, log, batch, *rows, run="1-a"):
    df = spark.createDataFrame([(at, at, "S9", zone, n, float(n)) for at, zone, n in rows], ROW)
    write_changelog_batch(df, batch, log, run=run)


def held(df):
    return sorted((r.window_start, r.zone_id, r.visitor_count) for r in df.collect())


def test_fold_updates_touched_dates_only(spark):
    root = scratch_path(spark, "t_fold")
    log, table = os.path.join(root, "log"), os.path.join(root, "table")
    put(spark, log, 0, (D1, "A", 2), (D2, "A", 1))
    put(spark, log, 1, (D1, "A", 3), (D1, "B", 1))
    assert fold_changelog(spark, log, table) == ["2031-03-04", "2031-03-05"]
    assert held(read_current(spark, table)) == [(D1, "A", 3), (D1, "B", 1), (D2, "A", 1)]
    assert fold_changelog(spark, log, table) == []
    before = current_dates(spark, table)
    put(spark, log, 2, (D1, "B", 5), (D3, "C", 7))  # a late update and a new date
    assert fold_changelog(spark, log, table) == ["2031-03-04", "2031-03-06"]
    assert held(read_current(spark, table)) == [(D1, "A", 3), (D1, "B", 5), (D2, "A", 1), (D3, "C", 7)]
    after = current_dates(spark, table)
    assert after["2031-03-05"] == before["2031-03-05"] and after["2031-03-04"] != before["2031-03-04"]
    assert held(read_newest_date(spark, table)) == [(D3, "C", 7)]
    assert live_visitors(read_newest_date(spark, table)).first().visitor_count == 7


def test_fold_takes_a_later_run_and_leaves_a_failed_generation(spark):
    root = scratch_path(spark, "t_fold_run")
    log, table = os.path.join(root, "log"), os.path.join(root, "table")
    put(spark, log, 8, (D1, "A", 4))
    fold_changelog(spark, log, table)
    # A fold that failed leaves rows without the mark of success: not read, and written over.
    put(spark, log, 0, (D1, "A", 1), run="2-b")  # batch ids begin again with a new checkpoint
    lost = os.path.join(table, "generation=00000002", "window_date=2031-03-04")
    read_current(spark, table).filter("false").drop("window_date").coalesce(1).write.parquet(lost)
    assert held(read_current(spark, table)) == [(D1, "A", 4)]
    assert fold_changelog(spark, log, table) == ["2031-03-04"]
    assert held(read_current(spark, table)) == [(D1, "A", 1)]


def test_fold_reads_new_batches_only(spark):
    root = scratch_path(spark, "t_fold_new")
    log, table = os.path.join(root, "log"), os.path.join(root, "table")
    put(spark, log, 0, (D1, "A", 2))
    fold_changelog(spark, log, table)
    put(spark, log, 1, (D2, "A", 2))
    with open(next(os.path.join(d, f) for d, _, fs in os.walk(batch_partition_path(log, 0, "1-a")) for f in fs if f.endswith(".parquet")), "wb") as f:
        f.write(b"not parquet")  # an old batch that is read again would fail the fold
    assert fold_changelog(spark, log, table) == ["2031-03-05"]


def test_expiry_leaves_the_table_and_the_mark(spark):
    root = scratch_path(spark, "t_expire")
    log, table = os.path.join(root, "log"), os.path.join(root, "table")
    assert expire_folded(spark, log, table) == []
    for n in range(4):
        put(spark, log, n, (D1, "A", n), *([(D2, "A", 1)] if n == 0 else []))
        fold_changelog(spark, log, table)
    put(spark, log, 4, (D3, "C", 9))  # not folded yet
    before = held(read_current(spark, table))
    gone = expire_folded(spark, log, table, keep=2)
    assert sorted(g.split("/")[-2] for g in gone if "generation=" in g) == ["generation=00000001"]  # replaced by the second fold of four
    assert sorted(g.split("/")[-1] for g in gone if "batch_id=" in g) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert held(read_current(spark, table)) == before == [(D1, "A", 3), (D2, "A", 1)]
    assert fold_changelog(spark, log, table) == ["2031-03-06"]
    assert held(read_current(spark, table)) == [(D1, "A", 3), (D2, "A", 1), (D3, "C", 9)]
    assert expire_folded(spark, log, table, keep=0) and held(read_current(spark, table)) == [(D1, "A", 3), (D2, "A", 1), (D3, "C", 9)]


def test_fold_command(spark):
    from footfall.__main__ import main

    root = scratch_path(spark, "t_fold_cli")
    log, table = os.path.join(root, "log"), os.path.join(root, "table")
    put(spark, log, 0, (D1, "A", 2))
    put(spark, log, 1, (D1, "A", 3))
    assert main(["fold", "--changelog", log, "--table", table, "--expire"]) == 0
    assert held(read_current(spark, table)) == [(D1, "A", 3)]
    assert not os.path.exists(batch_partition_path(log, 0, "1-a"))


def test_empty_table(spark):
    assert read_current(spark, os.path.join(scratch_path(spark, "t_none"), "table")).count() == 0


def test_newest_date_is_all_that_is_read(spark):
    table = folded_table(spark, SF_SMALL, "t_newest")
    files = read_newest_date(spark, table).inputFiles()
    assert files and {f.split("window_date=")[1].split("/")[0] for f in files} == {max(current_dates(spark, table))}


def test_append_to_catalog_table(spark):
    root = scratch_path(spark, "t_append")
    name = ensure_traffic_table(spark, "footfall_append", "stats", location=os.path.join(root, "t"), database_location=os.path.join(root, "db"))
    for n in (1, 2):
        append_to_table(spark.createDataFrame([(D1, D1, "S9", "A", n, 1.5)], ROW), name)
    assert sorted((r.store_id, r.zone_id, r.visitor_count) for r in spark.table(name).collect()) == [("S9", "A", 1), ("S9", "A", 2)]
    assert os.path.isdir(os.path.join(root, "t", "store_id=S9", "zone_id=A"))
