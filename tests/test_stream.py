import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from footfall.operators.aggregate import aggregate_traffic
from footfall.operators.changelog import latest_per_key
from footfall.operators.enrich import with_event_time
from footfall.operators.quality import clean_sensor_events
from footfall.schemas import ENVELOPE, SENSOR_EVENT
from footfall.session import scratch_path
from footfall.sinks.tables import (
    append_changelog_batch,
    changelog_batch_writer,
    read_changelog,
    write_changelog_batch,
)
from footfall.sources.replay import envelope_file_stream, write_replay_files
from footfall.streaming.traffic import dead_letter_stream, run_query, traffic_stream

T0 = dt.datetime(2024, 1, 1, 10, 0, tzinfo=dt.timezone.utc)


def ms(minute, second=0):
    return int((T0 + dt.timedelta(minutes=minute, seconds=second)).timestamp() * 1000)


def payload(eid, minute, dwell=5.0, store="S", zone="Z"):
    return json.dumps({"event_id": eid, "timestamp": ms(minute), "store_id": store, "zone_id": zone,
                       "dwell_time_seconds": dwell}).encode()


def replay(spark, batches, kind):
    """One file per micro-batch; ``batches`` is a list of lists of payload bytes."""
    rows = []
    for b, values in enumerate(batches):
        for i, v in enumerate(values):
            rows.append(("t", b"t", v, b * 1000 + i, None, b))
    schema = StructType(ENVELOPE.fields + [StructField("slice", LongType())])
    root = scratch_path(spark, kind)
    write_replay_files(spark.createDataFrame(rows, schema), os.path.join(root, "in"))
    return root, envelope_file_stream(spark, os.path.join(root, "in"), 1)


def collect_sink(out):
    def sink(df, batch_id):
        for r in df.collect():
            out.append((batch_id, r.window_start.strftime("%H:%M"), r.visitor_count))
    return sink


def test_update_mode_late_data_with_filler(spark):
    batches = [
        [payload("a", 1)],
        [payload("b", 17)],
        [payload("c", 18)],                       # filler: moves the watermark to 10:08
        [payload("late", 4), payload("d", 7)],    # 10:04 is late by window end
        [payload("e", 19)],
    ]
    root, stream = replay(spark, batches, "t_late")
    out = []
    res = run_query(spark, traffic_stream(stream), collect_sink(out), os.path.join(root, "ck"),
                    state_partitions=2)
    assert sorted(out) == [(0, "10:00", 1), (1, "10:15", 1), (2, "10:15", 2), (3, "10:05", 1),
                           (4, "10:15", 3)]
    assert res.dropped_by_watermark == 1
    assert [w[11:16] for w in res.watermarks] == ["00:00", "09:51", "10:07", "10:08", "10:08"]
    assert res.watermarks[0].startswith("1970")
    assert res.input_rows == 6
    assert res.observed["intake"]["records"] == 6


def test_late_filter_lags_one_batch(spark):
    # Without the filler batch the late row is still accepted: the late
    # filter of a batch uses the watermark of the batch before it.
    batches = [[payload("a", 1)], [payload("b", 17)], [payload("late", 4)]]
    root, stream = replay(spark, batches, "t_lag")
    out = []
    res = run_query(spark, traffic_stream(stream), collect_sink(out), os.path.join(root, "ck"),
                    state_partitions=2)
    assert (2, "10:00", 2) in out and res.dropped_by_watermark == 0


def test_invalid_events_do_not_move_watermark(spark):
    batches = [[payload("a", 1)], [payload("bad", 600, dwell=0.0)], [payload("b", 2)]]
    root, stream = replay(spark, batches, "t_wm")
    out = []
    run_query(spark, traffic_stream(stream), collect_sink(out), os.path.join(root, "ck"),
              state_partitions=2)
    assert (2, "10:00", 2) in out


def test_append_mode_emits_closed_windows_once(spark):
    batches = [[payload("a", 1), payload("b", 2)], [payload("c", 20)], [payload("d", 40)]]
    root, stream = replay(spark, batches, "t_append")
    out = []
    run_query(spark, traffic_stream(stream), collect_sink(out), os.path.join(root, "ck"),
              output_mode="append", state_partitions=2)
    # final watermark 10:30: windows 10:00 and 10:20 closed, 10:40 still open
    assert sorted((w, n) for _, w, n in out) == [("10:00", 2), ("10:20", 1)]


def test_dedup_option(spark):
    batches = [[payload("a", 1), payload("a", 1)], [payload("a", 2), payload("b", 2)]]
    root, stream = replay(spark, batches, "t_dedup")
    path = os.path.join(root, "cl")
    run_query(spark, traffic_stream(stream, dedup=True), changelog_batch_writer(path),
              os.path.join(root, "ck"), state_partitions=2)
    latest = latest_per_key(read_changelog(spark, path)).collect()
    assert [r.visitor_count for r in latest] == [2]


def test_dead_letters(spark):
    batches = [[payload("a", 1), b"\xff\xfe", b"<xml/>", payload("b", 2, store=None)]]
    root, stream = replay(spark, batches, "t_dlq")
    out = []

    def sink(df, batch_id):
        out.extend((r.reject_reason, r.offset) for r in df.collect())

    run_query(spark, dead_letter_stream(stream), sink, os.path.join(root, "ck"), output_mode="append")
    assert sorted(out) == [("invalid_utf8", 1), ("malformed_json", 2), ("missing_store_id", 3)]


def test_stream_equals_batch(spark):
    from conftest import SF_SMALL
    from footfall.plans.streamed import replay_traffic
    from footfall.sources.events import sensor_events

    changelog, res = replay_traffic(spark, SF_SMALL, "t_equal")
    cols = ["window_start", "store_id", "zone_id", "visitor_count", F.round("total_dwell_time", 4)]
    stream = {tuple(r) for r in latest_per_key(read_changelog(spark, changelog)).select(*cols).collect()}
    batch = aggregate_traffic(with_event_time(clean_sensor_events(sensor_events(spark, SF_SMALL))))
    assert stream == {tuple(r) for r in batch.select(*cols).collect()}
    assert res.batches >= 3


def test_idempotent_sink_vs_append(spark):
    root = scratch_path(spark, "t_sink")
    df = spark.createDataFrame([(T0, T0, "S", "Z", 1, 1.0)],
                               "window_start timestamp, window_end timestamp, store_id string, "
                               "zone_id string, visitor_count long, total_dwell_time double")
    idem, app = os.path.join(root, "idem"), os.path.join(root, "app")
    for _ in range(2):  # a batch re-run after a failure
        write_changelog_batch(df, 0, idem)
        append_changelog_batch(df, 0, app)
    write_changelog_batch(df, 1, idem)
    assert read_changelog(spark, idem).count() == 2
    assert read_changelog(spark, app).count() == 2  # batch 0 stored twice


def test_failed_sink_fails_query(spark):
    root, stream = replay(spark, [[payload("a", 1)]], "t_fail")

    def sink(df, batch_id):
        raise ValueError("sink down")

    with pytest.raises(Exception):
        run_query(spark, traffic_stream(stream), sink, os.path.join(root, "ck"), state_partitions=2)


def test_same_operators_on_bounded_input(spark):
    rows = [(payload("a", 1), ), (payload("b", 2), )]
    env = spark.createDataFrame([("t", b"t", v, i, None) for i, (v,) in enumerate(rows)], ENVELOPE)
    out = traffic_stream(env).collect()
    assert [(r.visitor_count, r.total_dwell_time) for r in out] == [(2, 10.0)]
    assert SENSOR_EVENT.fieldNames()[0] == "event_id"


def test_traffic_job_replay_with_dead_letters(spark):
    from footfall.streaming.job import TrafficJobConfig, start_traffic_job

    batches = [[payload("a", 1), b"\xff"], [payload("b", 20), payload("c", 2, dwell=-1.0)]]
    root, stream = replay(spark, batches, "t_job")
    cfg = TrafficJobConfig(
        changelog_path=os.path.join(root, "cl"), checkpoint_root=os.path.join(root, "ck"),
        dead_letter_path=os.path.join(root, "dlq"), available_now=True, state_partitions=2)
    traffic, dlq = start_traffic_job(spark, stream, cfg)
    assert traffic.batches >= 2 and dlq.batches >= 2
    latest = latest_per_key(read_changelog(spark, cfg.changelog_path))
    assert sorted(r.visitor_count for r in latest.collect()) == [1, 1]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(cfg.dead_letter_path).collect())
    assert reasons == ["dwell_not_positive", "invalid_utf8"]


def test_compaction_and_table_ddl(spark):
    from footfall.sinks.tables import compact_changelog, ensure_traffic_table, write_changelog

    root = scratch_path(spark, "t_compact")
    rows = [(0, T0, T0, "S", "Z", 1, 1.0), (1, T0, T0, "S", "Z", 3, 4.0), (1, T0, T0, "S", "Y", 1, 2.0)]
    log = spark.createDataFrame(rows, "batch_id long, window_start timestamp, window_end timestamp, "
                                      "store_id string, zone_id string, visitor_count long, "
                                      "total_dwell_time double")
    write_changelog(log, os.path.join(root, "cl"))
    current = compact_changelog(spark, os.path.join(root, "cl"), os.path.join(root, "current"))
    assert sorted((r.zone_id, r.visitor_count) for r in current.collect()) == [("Y", 1), ("Z", 3)]
    assert "window_date" in current.columns
    name = ensure_traffic_table(spark, "footfall_test", "traffic_stats", location=os.path.join(root, "tbl"),
                                database_location=os.path.join(root, "db"))
    assert ensure_traffic_table(spark, "footfall_test", "traffic_stats",
                                location=os.path.join(root, "tbl")) == name
    assert spark.table(name).columns == ["window_start", "window_end", "visitor_count",
                                         "total_dwell_time", "store_id", "zone_id"]


def test_counting_sink_does_not_double_state_metrics(spark):
    # Counting and writing a micro-batch runs its plan once (persisted),
    # so the watermark-drop metric stays exact.
    batches = [[payload("a", 1)], [payload("b", 17)], [payload("c", 18)],
               [payload("late", 4), payload("d", 7)]]
    root, stream = replay(spark, batches, "t_count")
    res = run_query(spark, traffic_stream(stream),
                    changelog_batch_writer(os.path.join(root, "cl"), count_rows=True),
                    os.path.join(root, "ck"), state_partitions=2)
    assert res.dropped_by_watermark == 1


def test_kafka_source_validates_starting_offsets(spark):
    from footfall.sources.bus import kafka_envelope_stream

    with pytest.raises(ValueError):
        kafka_envelope_stream(spark, "broker:9092", "sensor-traffic", starting_offsets="middle")


def _replay_with_bus_time(spark, batches, kind):
    """Like ``replay`` but each payload comes with its arrival minute."""
    rows = []
    for b, values in enumerate(batches):
        for i, (v, arrival) in enumerate(values):
            rows.append(("t", b"t", v, b * 1000 + i, T0 + dt.timedelta(minutes=arrival), b))
    schema = StructType(ENVELOPE.fields + [StructField("slice", LongType())])
    root = scratch_path(spark, kind)
    write_replay_files(spark.createDataFrame(rows, schema), os.path.join(root, "in"))
    return root, envelope_file_stream(spark, os.path.join(root, "in"), 1)


@pytest.mark.parametrize("guard", [False, True])
def test_future_timestamp_guard_protects_watermark(spark, guard):
    # A sensor with a clock 10 hours ahead: without the guard it moves the
    # watermark to 19:50; one batch later (the late filter lags a batch)
    # on-time events are dropped as late and their window is evicted.
    batches = [[(payload("a", 1), 1)], [(payload("clock", 600), 2)], [(payload("c", 2), 2)],
               [(payload("b", 3), 3)]]
    root, stream = _replay_with_bus_time(spark, batches, f"t_future_{guard}")
    out = []
    res = run_query(spark, traffic_stream(stream, max_future_skew_ms=60_000 if guard else None),
                    collect_sink(out), os.path.join(root, "ck"), state_partitions=2)
    ten = max((n for _, w, n in out if w == "10:00"), default=0)
    assert ten == (3 if guard else 2)
    assert res.dropped_by_watermark == (0 if guard else 1)
    assert any(w == "20:00" for _, w, _ in out) is (not guard)


def test_every_late_duplicate_is_dropped(spark):
    from conftest import SF_SMALL
    from footfall.plans.streamed import replay_traffic
    from footfall.sources.events import sensor_events

    _, res = replay_traffic(spark, SF_SMALL, "t_late_all", late_copies=True)
    clean = clean_sensor_events(sensor_events(spark, SF_SMALL)).withColumn(
        "w", F.window(F.timestamp_millis("timestamp"), "5 minutes"))
    end = clean.agg(F.max(F.timestamp_millis("timestamp")) - F.expr("INTERVAL 10 MINUTES")).first()[0]
    late = clean.filter(F.col("w.end") <= F.lit(end))
    copies, keys = late.count(), late.select("w", "store_id", "zone_id").distinct().count()
    assert copies > 0
    # The metric counts rows reaching the state operator, i.e. after the
    # map-side partial aggregate: copies of one key in one task count once.
    assert keys <= res.dropped_by_watermark <= copies


def test_command_line_stream_replay(spark):
    from footfall.__main__ import main

    root, _ = replay(spark, [[payload("a", 1)], [payload("b", 2), b"\xff"]], "t_cli")
    cl, dlq = os.path.join(root, "cl"), os.path.join(root, "dlq")
    assert main(["stream", "--replay-dir", os.path.join(root, "in"), "--changelog", cl,
                 "--checkpoint", os.path.join(root, "ck"), "--dead-letters", dlq,
                 "--available-now", "--state-partitions", "2"]) == 0
    assert [r.visitor_count for r in latest_per_key(read_changelog(spark, cl)).collect()] == [2]
    assert [r.reject_reason for r in spark.read.parquet(dlq).collect()] == ["invalid_utf8"]


def _crash_once_after_write(inner, crash_batch):
    state = {"crashed": False}

    def sink(df, batch_id):
        inner(df, batch_id)
        if batch_id == crash_batch and not state["crashed"]:
            state["crashed"] = True
            raise RuntimeError("driver lost after the write, before the commit")

    return sink


@pytest.mark.parametrize("idempotent", [True, False])
def test_restart_after_failure_is_exactly_once(spark, idempotent):
    batches = [[payload("a", 1)], [payload("b", 2)], [payload("c", 3)], [payload("d", 7)]]
    root, stream = replay(spark, batches, f"t_restart_{idempotent}")
    path, ck = os.path.join(root, "cl"), os.path.join(root, "ck")
    sink = _crash_once_after_write(changelog_batch_writer(path, idempotent=idempotent), 2)
    with pytest.raises(Exception):
        run_query(spark, traffic_stream(stream), sink, ck, state_partitions=2)
    # Restart from the checkpoint: batch 2 runs again, then the rest.
    stream2 = envelope_file_stream(spark, os.path.join(root, "in"), 1)
    run_query(spark, traffic_stream(stream2), sink, ck, state_partitions=2)
    log = read_changelog(spark, path)
    per_batch = sorted((r.batch_id, r.visitor_count) for r in log.filter("window_start is not null").collect())
    clean = [(0, 1), (1, 2), (2, 3), (3, 1)]
    if idempotent:
        assert per_batch == clean
    else:
        assert per_batch == sorted(clean + [(2, 3)])  # batch 2 stored twice
    latest = {r.visitor_count for r in latest_per_key(log).collect()}
    assert latest == {3, 1}


@pytest.mark.parametrize("bad", [
    {"output_mode": "complete"}, {"watermark_delay": "ten minutes"}, {"window_duration": "5"},
    {"trigger_interval": ""}, {"state_partitions": 0}, {"max_future_skew_ms": -1},
    {"changelog_path": ""},
])
def test_job_config_validation(bad):
    from footfall.streaming.job import TrafficJobConfig

    args = dict(changelog_path="/x/cl", checkpoint_root="/x/ck")
    args.update(bad)
    with pytest.raises(ValueError):
        TrafficJobConfig(**args)
    assert TrafficJobConfig(changelog_path="/x/cl", checkpoint_root="/x/ck",
                            watermark_delay="1 hour", trigger_interval="500 milliseconds")


@pytest.mark.parametrize("salted", [False, True])
def test_dimension_join_on_a_stream(spark, salted):
    from footfall.operators.enrich import join_dimensions
    from footfall.schemas import STORES, ZONES
    from footfall.streaming.traffic import accepted_event_stream

    stores = spark.createDataFrame([("S", "Main", None, None, "UTC", None)], STORES)
    zones = spark.createDataFrame([("Z", "S", "Dairy", "Dairy", None, None)], ZONES)
    batches = [[payload("a", 1)], [payload("b", 2, zone="Q"), payload("c", 3, store="X")]]
    root, stream = replay(spark, batches, f"t_dimstream_{salted}")
    enriched = join_dimensions(accepted_event_stream(stream, watermark_delay=None), stores, zones,
                               salted=salted)
    out = []

    def sink(df, batch_id):
        out.extend((r.event_id, r.store_name, r.zone_name) for r in df.collect())

    run_query(spark, enriched, sink, os.path.join(root, "ck"), output_mode="append")
    assert sorted(out, key=lambda t: t[0]) == [("a", "Main", "Dairy"), ("b", "Main", None), ("c", None, None)]


def test_stream_plan_aggregates_before_the_shuffle(spark):
    import contextlib
    import io

    root, stream = replay(spark, [[payload("a", 1), payload("b", 2)]], "t_splan")
    q = (traffic_stream(stream).writeStream.outputMode("update")
         .option("checkpointLocation", os.path.join(root, "ck")).format("noop")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    # partial aggregate -> one exchange on the key -> state restore/save
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("StateStoreSave") < plan.index("Exchange") < plan.index("partial_count")


def test_command_line_failure_returns_non_zero(spark):
    from footfall.__main__ import main

    root, _ = replay(spark, [[payload("a", 1)]], "t_cli_fail")
    # The change-log path is an existing regular file, so the first batch's write fails.
    blocker = os.path.join(root, "blocker")
    with open(blocker, "w") as fh:
        fh.write("not a folder")
    code = main(["stream", "--replay-dir", os.path.join(root, "in"),
                 "--changelog", blocker, "--checkpoint", os.path.join(root, "ck"),
                 "--available-now", "--keep-session"])
    assert code == 1


def test_lateness_is_judged_on_window_end(spark):
    # After the filler the watermark is 10:07. An event at 10:06 is older than
    # the watermark, but its window (10:05-10:10) ends after it: still counted.
    batches = [[payload("a", 1)], [payload("b", 17)], [payload("filler", 18)], [payload("old", 6)]]
    root, stream = replay(spark, batches, "t_window_end")
    out = []
    res = run_query(spark, traffic_stream(stream), collect_sink(out), os.path.join(root, "ck"),
                    state_partitions=2)
    assert (3, "10:05", 1) in out and res.dropped_by_watermark == 0


def test_command_line_compact(spark):
    from footfall.__main__ import main

    root, _ = replay(spark, [[payload("a", 1)], [payload("b", 2)]], "t_cli_compact")
    cl = os.path.join(root, "cl")
    assert main(["stream", "--replay-dir", os.path.join(root, "in"), "--changelog", cl,
                 "--checkpoint", os.path.join(root, "ck"), "--available-now",
                 "--state-partitions", "2"]) == 0
    out = os.path.join(root, "current")
    assert main(["compact", "--changelog", cl, "--out", out]) == 0
    rows = spark.read.parquet(out).collect()
    assert [(r.visitor_count, str(r.window_date)) for r in rows] == [(2, "2024-01-01")]


def test_a_slice_of_few_rows_is_a_batch_of_its_own(spark):
    """Slices of one and two rows between longer ones still take a batch each."""
    root = scratch_path(spark, "t_small_slices")
    sizes = {0: 40, 1: 1, 2: 2, 3: 40}
    slices = [n for n, size in sizes.items() for _ in range(size)]
    rows = [("t", None, b"x", i, dt.datetime(2030, 1, 1), n) for i, n in enumerate(slices)]
    env = spark.createDataFrame(rows, "topic string, key binary, value binary, offset long, timestamp timestamp, slice long")
    write_replay_files(env, root, files_per_slice=4)
    seen = []
    run_query(
        spark, envelope_file_stream(spark, root, max_files_per_trigger=4), lambda b, i: seen.append((i, b.count())),
        scratch_path(spark, "t_small_slices_checkpoint"), output_mode="append",
    )
    assert [n for _, n in sorted(seen)] == list(sizes.values())
