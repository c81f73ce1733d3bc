from conftest import event
from pyspark.sql import functions as F

from footfall.operators.enrich import enrich_with_time_flags, with_event_time


def flags(events, ms):
    rows = [event(event_id=str(i), timestamp=t) for i, t in enumerate(ms)]
    out = enrich_with_time_flags(events(rows)).orderBy(F.col("event_id").cast("int")).collect()
    return [(r.is_peak_hour, r.is_weekend) for r in out]


def test_peak_hour_reference_cases(events):
    # 09:00 UTC and 02:00 UTC on 1970-01-01 (a Thursday)
    assert flags(events, [32400000, 7200000]) == [(True, False), (False, False)]


def test_peak_hour_boundaries(events):
    assert flags(events, [64799999, 64800000, 32399999]) == [
        (True, False),
        (False, False),
        (False, False),
    ]


def test_weekend(events):
    sunday, monday, saturday = 1704585600000, 1704067200000, 1704499200000
    assert [w for _, w in flags(events, [sunday, monday, saturday])] == [True, False, True]


def test_null_and_poison_time_give_false(events):
    assert flags(events, [None, 2**63 - 1]) == [(False, False), (False, False)]


def test_helper_columns_absent(events):
    cols = enrich_with_time_flags(events([event()])).columns
    assert cols[-2:] == ["is_peak_hour", "is_weekend"]
    assert "event_hour" not in cols and "event_timestamp" not in cols


def test_event_time_is_exact_and_guarded(events):
    rows = [
        event(event_id="a", timestamp=1704585600123),
        event(event_id="b", timestamp=None),
        event(event_id="c", timestamp=2**63 - 1),
        event(event_id="d", timestamp=-62135596800001),
    ]
    out = {
        r.event_id: r.ms
        for r in with_event_time(events(rows))
        .select("event_id", F.unix_millis("event_time").alias("ms"))
        .collect()
    }
    assert out == {"a": 1704585600123, "b": None, "c": None, "d": None}
