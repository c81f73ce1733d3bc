"""Totals, rejects, restarts and waiting of the streaming job."""

import os
import time

import pytest
from pyspark.sql import functions as F
from test_stream import payload, replay

from footfall.operators.changelog import latest_per_key
from footfall.operators.parse import decode_envelope
from footfall.operators.quality import accepted_events, classify_events, quality_profile
from footfall.schemas import SENSOR_EVENT
from footfall.sinks.tables import changelog_batch_writer, forwarded_records, read_changelog
from footfall.streaming.job import TrafficJobConfig, await_job, start_traffic_job
from footfall.streaming.traffic import (
    dead_letter_stream,
    intake_events,
    intake_stream,
    read_rejected,
    run_query,
    traffic_stream,
)


def test_totals_cover_more_batches_than_a_query_remembers(spark):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        root, stream = replay(spark, [[payload(str(i), 1)] for i in range(6)], "t_totals")
        res = run_query(spark, traffic_stream(stream), lambda df, i: df.count(), os.path.join(root, "ck"), state_partitions=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert res.batches == 6 and res.observed["intake"]["records"] == 6


def test_a_new_checkpoint_keeps_earlier_runs(spark):
    root, first = replay(spark, [[payload("a", 1)]], "t_runs_a")
    other, second = replay(spark, [[payload("b", 31)], [payload("c", 1), payload("d", 2)]], "t_runs_b")
    path = os.path.join(root, "log")
    for n, stream in enumerate((first, second)):
        run_query(spark, traffic_stream(stream, watermark_delay="1 hour"), changelog_batch_writer(path), os.path.join(root, f"ck{n}"), state_partitions=1)
    log = read_changelog(spark, path)
    assert log.select("run").distinct().count() == 2 and log.count() == 3
    counts = sorted(r.visitor_count for r in latest_per_key(log).collect())
    assert counts == [1, 2]  # the later run's row of a window wins, the other window stays


@pytest.mark.parametrize("skew", [None, 1000])
def test_accepted_and_rejected_add_up(spark, skew):
    rows = [("t", b"t", payload("a", 1).encode() if isinstance(payload("a", 1), str) else payload("a", 1), 1, None), ("t", b"t", b"\xff", 2, None), ("t", b"t", b"{", 3, None)]
    env = spark.createDataFrame(rows, "topic string, key binary, value binary, offset long, timestamp timestamp")
    env = env.selectExpr("topic", "key", "value", "offset", "timestamp'2000-01-01' as timestamp", "7 as partition")
    bounds = {} if skew is None else {"max_future_skew_ms": skew}
    accepted = accepted_events(classify_events(decode_envelope(env, carry=["bus_time"]), **bounds)).count()
    rejected = dead_letter_stream(env, skew).collect()
    assert accepted + len(rejected) == 3 and accepted == (1 if skew is None else 0)
    assert {r.partition for r in rejected} == {7}
    assert sorted(bytes(r.value) for r in forwarded_records(env).collect()) == sorted(bytes(r[2]) for r in (rows[0], rows[2]))


def test_intake_table_feeds_the_traffic_query(spark):
    batches = [[payload("a", 1), b"\xff", b"{"], [payload("b", 2), payload("c", 3, dwell=-1.0)], [payload("d", 31)]]
    root, stream = replay(spark, batches, "t_intake")
    cfg = TrafficJobConfig(
        os.path.join(root, "log"), os.path.join(root, "ck"), intake_path=os.path.join(root, "intake"),
        intake_files_per_trigger=1, state_partitions=1, available_now=True,
    )
    intake, traffic = start_traffic_job(spark, stream, cfg)
    assert intake.input_rows == 6 and intake.observed["intake"] == {"records": 6, "invalid_utf8": 1}
    assert traffic.input_rows == 3  # rejects are not read
    counts = latest_per_key(read_changelog(spark, cfg.changelog_path)).collect()
    assert sorted(r.visitor_count for r in counts) == [1, 2]
    rejected = read_rejected(spark, cfg.intake_path).collect()
    assert sorted(r.reject_reason for r in rejected) == ["dwell_not_positive", "invalid_utf8", "malformed_json"]
    assert spark.read.parquet(cfg.intake_path).count() == 6
    start_traffic_job(spark, stream, cfg)  # nothing new: nothing is counted twice
    counts = latest_per_key(read_changelog(spark, cfg.changelog_path)).collect()
    assert sorted(r.visitor_count for r in counts) == [1, 2]
    with pytest.raises(ValueError):
        TrafficJobConfig("a", "b", dead_letter_path="c", intake_path="d")


def test_intake_rejects_an_event_from_the_future(spark):
    root, stream = replay(spark, [[payload("a", 1)]], "t_intake_future")
    stream = stream.withColumn("timestamp", F.lit("2000-01-01").cast("timestamp"))
    out = os.path.join(root, "intake")
    run_query(spark, intake_stream(stream, 1000), out, os.path.join(root, "ck"), output_mode="append", partition_by="rejected")
    assert [r.reject_reason for r in read_rejected(spark, out).collect()] == ["future_timestamp"]
    assert intake_events(spark, out).isStreaming


def test_running_job_reads_the_bus_once(spark):
    root, stream = replay(spark, [[payload("a", 1)], [payload("b", 2)]], "t_intake_live")
    cfg = TrafficJobConfig(
        os.path.join(root, "log"), os.path.join(root, "ck"), intake_path=os.path.join(root, "intake"),
        trigger_interval="1 second", state_partitions=1,
    )
    queries = start_traffic_job(spark, stream, cfg)
    until, seen = time.monotonic() + 60, 0
    while seen < 2 and time.monotonic() < until:
        time.sleep(0.5)
        if os.path.isdir(cfg.changelog_path):
            try:
                seen = max((r.visitor_count for r in read_changelog(spark, cfg.changelog_path).collect()), default=0)
            except Exception:  # a batch is being written
                seen = 0
    await_job(spark, queries, timeout_s=0)
    assert seen == 2 and len(queries) == 2 and all(q.isActive for q in queries)
    queries[0].stop()
    await_job(spark, queries)


def test_profile_without_a_valid_dwell(spark, events):
    for frame in (spark.createDataFrame([], SENSOR_EVENT), events([])):
        row = quality_profile(frame).first()
        assert row.n_events == 0 and row.share_dwell_under_30s is None and row.n_distinct_event_ids == 0


def test_waiting_ignores_queries_of_others_and_stops_the_rest(spark):
    root, done = replay(spark, [[payload("a", 1)]], "t_wait_a")
    run_query(spark, traffic_stream(done), lambda df, i: df.count(), os.path.join(root, "ck"), state_partitions=1)
    live_root, live = replay(spark, [[payload("a", 1)]], "t_wait_b")
    queries = [
        run_query(spark, traffic_stream(live), lambda df, i: df.count(), os.path.join(live_root, f"ck{n}"), available_now=False, trigger_interval="1 second", state_partitions=1)
        for n in range(2)
    ]
    began = time.monotonic()
    await_job(spark, queries, timeout_s=3)
    assert time.monotonic() - began >= 3 and all(q.isActive for q in queries)
    queries[0].stop()
    await_job(spark, queries)
    assert not any(q.isActive for q in queries)
