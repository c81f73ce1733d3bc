"""Property tests: operators against brute-force Python on random inputs."""

import datetime as dt
import json
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators.aggregate import aggregate_traffic
from footfall.operators.parse import decode_envelope
from footfall.operators.quality import classify_events, clean_sensor_events
from footfall.schemas import ENVELOPE, SENSOR_EVENT

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

REASONS = {
    "invalid_utf8", "empty_payload", "malformed_json", "missing_event_id", "missing_store_id",
    "missing_zone_id", "invalid_dwell_time", "dwell_not_positive", "dwell_too_long", "bad_timestamp",
}

ids = st.one_of(st.none(), st.sampled_from(["", "a", "b", "STORE_01", "ZONE_A"]))
dwell = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=64),
                  st.sampled_from([0.0, 3600.0, 3600.0000001, -0.0, 1e-300]))
millis = st.one_of(st.none(), st.integers(min_value=-(2**63), max_value=2**63 - 1),
                   st.integers(min_value=0, max_value=4102444800000))


def event_rows():
    return st.lists(
        st.tuples(ids, millis, ids, ids, ids, ids, ids, dwell), min_size=1, max_size=40)


def payloads():
    obj = st.fixed_dictionaries({}, optional={
        "event_id": st.one_of(st.none(), st.text(max_size=4), st.integers()),
        "timestamp": st.one_of(st.none(), st.integers(min_value=-(2**63), max_value=2**63 - 1),
                               st.text(max_size=3), st.floats(allow_nan=False)),
        "store_id": st.one_of(st.none(), st.text(max_size=3)),
        "zone_id": st.one_of(st.none(), st.text(max_size=3)),
        "dwell_time_seconds": st.one_of(st.none(), st.floats(allow_nan=False), st.text(max_size=3)),
        "face_id": st.text(max_size=3),
    })
    as_json = obj.map(lambda d: json.dumps(d).encode())
    return st.lists(st.one_of(as_json, st.binary(max_size=12), st.none()), min_size=1, max_size=30)


def py_clean(row):
    eid, _, store, zone, _, _, _, d = row
    return (d is not None and not math.isnan(d) and 0.0 < d <= 3600.0
            and store is not None and zone is not None and eid is not None)


@SETTINGS
@given(rows=event_rows())
def test_clean_matches_python(spark, rows):
    df = spark.createDataFrame(rows, SENSOR_EVENT)
    got = sorted(map(repr, (tuple(r) for r in clean_sensor_events(df).collect())))
    want = sorted(map(repr, (r for r in rows if py_clean(r))))
    assert got == want


@SETTINGS
@given(values=payloads())
def test_every_record_is_accepted_or_has_a_known_reason(spark, values):
    env = spark.createDataFrame([("t", b"t", v, i, None) for i, v in enumerate(values)], ENVELOPE)
    out = classify_events(decode_envelope(env)).collect()
    assert len(out) == len(values)
    for r in out:
        if r.reject_reason is None:
            assert r.event_id is not None and r.store_id is not None and r.zone_id is not None
            assert 0.0 < r.dwell_time_seconds <= 3600.0
            assert -62135596800000 <= r.timestamp <= 253402300799999
        else:
            assert r.reject_reason in REASONS


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(min_value=0, max_value=3 * 3600 * 1000),
                               st.sampled_from(["S1", "S2"]), st.sampled_from(["A", "B", "C"]),
                               st.integers(min_value=1, max_value=1000)), min_size=1, max_size=60),
       window_min=st.sampled_from([1, 5, 15]))
def test_window_aggregate_matches_python(spark, rows, window_min):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [(base + dt.timedelta(milliseconds=ms), s, z, d / 10) for ms, s, z, d in rows]
    df = spark.createDataFrame(data, "event_time timestamp, store_id string, zone_id string, "
                                     "dwell_time_seconds double")
    width = window_min * 60_000
    want = defaultdict(lambda: [0, 0.0])
    for ms, s, z, d in rows:
        key = (ms // width * width, s, z)
        want[key][0] += 1
        want[key][1] += d / 10
    got = {}
    base_ms = int(base.timestamp() * 1000)
    out = aggregate_traffic(df, f"{window_min} minutes").select(
        F.unix_millis("window_start").alias("s"), F.unix_millis("window_end").alias("e"),
        "store_id", "zone_id", "visitor_count", "total_dwell_time")
    for r in out.collect():
        assert r.e - r.s == width
        got[(r.s - base_ms, r.store_id, r.zone_id)] = (r.visitor_count, round(r.total_dwell_time, 6))
    assert got == {k: (n, round(v, 6)) for k, (n, v) in want.items()}


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(min_value=0, max_value=4),            # batch
                               st.integers(min_value=0, max_value=30 * 60_000),  # ms
                               st.sampled_from(["S1", "S2"]),
                               st.integers(min_value=1, max_value=100)), min_size=1, max_size=50))
def test_changelog_matches_python(spark, rows):
    from footfall.operators.changelog import changelog_by_batch, latest_per_key

    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [(b, base + dt.timedelta(milliseconds=ms), s, "Z", float(d)) for b, ms, s, d in rows]
    df = spark.createDataFrame(data, "batch_id long, event_time timestamp, store_id string, "
                                     "zone_id string, dwell_time_seconds double")
    width = 300_000
    per = defaultdict(lambda: [0, 0.0])
    for b, ms, s, d in rows:
        per[(b, ms // width * width, s)][0] += 1
        per[(b, ms // width * width, s)][1] += d
    want, running = {}, defaultdict(lambda: [0, 0.0])
    for (b, w, s) in sorted(per):
        running[(w, s)][0] += per[(b, w, s)][0]
        running[(w, s)][1] += per[(b, w, s)][1]
        want[(b, w, s)] = (running[(w, s)][0], running[(w, s)][1])
    base_ms = int(base.timestamp() * 1000)
    log = changelog_by_batch(df).select(
        "batch_id", (F.unix_millis("window_start") - base_ms).alias("w"), "store_id",
        "visitor_count", "total_dwell_time")
    got = {(r.batch_id, r.w, r.store_id): (r.visitor_count, r.total_dwell_time) for r in log.collect()}
    assert got == want
    latest = {(r.store_id, r.visitor_count) for r in latest_per_key(changelog_by_batch(df)).collect()}
    final = {}
    for (b, w, s), v in sorted(want.items()):
        final[(w, s)] = v[0]
    assert latest == {(s, n) for (w, s), n in final.items()}
