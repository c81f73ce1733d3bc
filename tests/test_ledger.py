"""The commit ledger, the accounted intake and duplicate ids."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from footfall.operators.accounting import audit_intervals, merged_findings, offset_intervals, unbalanced
from footfall.operators.quality import duplicate_ids
from footfall.schemas import ENVELOPE, TRAFFIC_STATS
from footfall.session import scratch_path
from footfall.sinks.ledger import CommitLedger, append_once, expire_attempts, put_if_absent, read_once_table
from footfall.sources.bus import bus_envelope
from footfall.sources.replay import envelope_file_stream, replay_slice, write_replay_files
from footfall.streaming.accounted import ACCEPTED, accounted_records, accounted_writer, batch_accounts, read_accounted, read_intervals
from footfall.streaming.job import TrafficJobConfig, start_traffic_job
from footfall.streaming.traffic import run_query

SF = "/root/testdata/sf0.001"
RUN = "0000000000001-test"


def traffic(spark, *counts):
    rows = [(f"2024-01-0{i + 1} 00:00:00", f"2024-01-0{i + 1} 00:05:00", "s", None if i else "z", n, 1.0) for i, n in enumerate(counts)]
    names = [f.name for f in TRAFFIC_STATS.fields]
    return spark.createDataFrame(rows, "a string, b string, c string, d string, e long, f double").select(
        F.col("a").cast("timestamp").alias(names[0]), F.col("b").cast("timestamp").alias(names[1]),
        *[F.col(c).alias(n) for c, n in zip("cdef", names[2:])],
    )


def counts(df):
    return sorted(r.visitor_count for r in df.collect())


def test_a_file_is_put_once(spark):
    path = os.path.join(scratch_path(spark, "put"), "entry.json")
    os.makedirs(os.path.dirname(path))
    assert put_if_absent(spark, path, "first") and not put_if_absent(spark, path, "second")
    assert open(path).read() == "first"
    assert os.listdir(os.path.dirname(path)) == [n for n in os.listdir(os.path.dirname(path)) if "tmp" not in n]


def test_a_batch_counts_once(spark):
    path = scratch_path(spark, "once")
    assert append_once(traffic(spark, 1, 2), 0, path, RUN)
    assert not append_once(traffic(spark, 1, 2), 0, path, RUN)
    assert append_once(traffic(spark, 5), 1, path, RUN)
    assert counts(read_once_table(spark, path)) == [2, 5]  # the first key was updated by the later batch
    assert counts(read_once_table(spark, path, latest=False)) == [1, 2, 5]


def test_what_is_not_committed_is_not_read(spark):
    path = scratch_path(spark, "lost")

    def die(batch_id):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        append_once(traffic(spark, 7), 0, path, RUN, before_commit=die)
    assert counts(read_once_table(spark, path, latest=False)) == []
    # A slower writer of the same batch finds the other one's commit in its place.
    assert append_once(traffic(spark, 1), 0, path, RUN, before_commit=lambda b: None)
    ledger = CommitLedger(spark, path)
    assert not ledger.commit(RUN, 0, "another attempt")
    overtaken = append_once(traffic(spark, 9), 1, path, RUN, before_commit=lambda b: append_once(traffic(spark, 3), b, path, RUN))
    assert not overtaken and counts(read_once_table(spark, path, latest=False)) == [1, 3]
    assert expire_attempts(spark, path) == []  # too young
    assert len(expire_attempts(spark, path, older_than_s=-5)) == 2
    assert counts(read_once_table(spark, path, latest=False)) == [1, 3]


def test_the_job_appends_its_table_and_accounts(spark):
    root = scratch_path(spark, "job_table")
    env = bus_envelope(spark, SF, faults=True).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    write_replay_files(env, f"{root}/in")
    cfg = TrafficJobConfig(f"{root}/log", f"{root}/cp", table_path=f"{root}/table", accounted_path=f"{root}/seen", available_now=True, state_partitions=2)
    from footfall.sinks.tables import read_changelog

    for _ in range(2):  # the second run finds nothing new
        start_traffic_job(spark, envelope_file_stream(spark, f"{root}/in"), cfg)
    log = read_changelog(spark, f"{root}/log")
    table = read_once_table(spark, f"{root}/table", latest=False)
    assert table.count() == log.count() and sum(counts(table)) == sum(counts(log))
    accounts = batch_accounts(spark, f"{root}/seen")
    assert accounts.agg(F.sum("read")).first()[0] == env.count() and unbalanced(accounts).count() == 0


def test_a_lost_intake_batch_is_neither_missing_nor_double(spark):
    root = scratch_path(spark, "lost_intake")
    env = bus_envelope(spark, SF).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    write_replay_files(env, f"{root}/in")
    lost = []

    def die(batch_id):
        if batch_id == 2 and not lost:
            lost.append(batch_id)
            raise RuntimeError("lost")

    def run():
        stream = accounted_records(envelope_file_stream(spark, f"{root}/in"))
        run_query(spark, stream, accounted_writer(f"{root}/seen", before_commit=die), f"{root}/cp", output_mode="append")

    with pytest.raises(Exception):
        run()
    run()
    seen = read_accounted(spark, f"{root}/seen")
    assert lost and seen.count() == seen.select("offset").distinct().count() == env.count()
    assert read_intervals(spark, f"{root}/seen").agg(F.sum("n_records")).first()[0] == env.count()
    assert unbalanced(batch_accounts(spark, f"{root}/seen")).count() == 0
    assert read_accounted(spark, f"{root}/seen", ACCEPTED).filter("reject_reason IS NOT NULL").count() == 0


def test_audit_against_a_plain_count(spark):
    rng = random.Random(2)
    rows, want = [], set()
    for partition in (0, None):
        times = [rng.choice([0, 1, 1, 1, 2, 3]) for _ in range(400)]
        times[0] = times[-1] = 1
        for offset, n in enumerate(times):
            rows += [(partition, rng.randint(0, 3), offset + 37) for _ in range(n)]
        for kind, hit in (("gap", lambda n: n == 0), ("overlap", lambda n: n > 1)):
            start = None
            for i, n in enumerate([*times, 1]):
                if hit(n) and start is None:
                    start = i
                elif not hit(n) and start is not None:
                    want.add((partition, kind, start + 37, i + 36))
                    start = None
    df = spark.createDataFrame(rows + [(0, 1, None)], "partition int, batch_id int, offset long")
    for block in (16, 1 << 20):
        found = merged_findings(audit_intervals(offset_intervals(df, ["partition", "batch_id"], block=block), ["partition"]), ["partition"])
        assert {(r.partition, r.kind, r.first_offset, r.last_offset) for r in found.collect()} == want


def test_unbalanced_batches_show(spark):
    rows = spark.createDataFrame([(0, 3, 1, 1, 1), (1, 3, 1, 1, 0)], "batch_id int, read long, accepted long, rejected long, late long")
    assert [r.batch_id for r in unbalanced(rows).collect()] == [1]


@pytest.mark.parametrize("suspects", [2_000_000, 3])
def test_duplicate_ids(spark, suspects):
    rng = random.Random(6)
    ids = [str(rng.randint(0, 700)) for _ in range(1000)] + [None] * 5 + ["hot"] * 500 + [uuid.uuid4().hex for _ in range(300)]
    got = duplicate_ids(spark.createDataFrame([(i,) for i in ids], "event_id string").repartition(5), suspects=suspects)
    want = {i: ids.count(i) for i in set(ids) if i is not None and ids.count(i) > 1}
    assert {r.event_id: r.n_events for r in got.collect()} == want
    assert duplicate_ids(spark.createDataFrame([], "event_id string")).collect() == []


def test_only_suspect_ids_move(spark):
    events = spark.range(100_000).select(F.col("id").cast("string").alias("event_id"))
    plan = duplicate_ids(events)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
