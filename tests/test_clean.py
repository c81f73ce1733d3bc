import math

from conftest import event

from footfall.operators.quality import clean_sensor_events


def kept(events, rows, **kw):
    return sorted(r.event_id for r in clean_sensor_events(events(rows), **kw).collect())


def test_dwell_bounds_reference_cases(events):
    rows = [
        event(event_id="zero", dwell_time_seconds=0.0),
        event(event_id="normal", dwell_time_seconds=5.0),
        event(event_id="long", dwell_time_seconds=3700.0),
        event(event_id="just_over", dwell_time_seconds=3601.0),
    ]
    assert kept(events, rows) == ["normal"]


def test_dwell_boundary_and_special_values(events):
    rows = [
        event(event_id="max", dwell_time_seconds=3600.0),
        event(event_id="neg", dwell_time_seconds=-1.0),
        event(event_id="null", dwell_time_seconds=None),
        event(event_id="nan", dwell_time_seconds=math.nan),
        event(event_id="inf", dwell_time_seconds=math.inf),
        event(event_id="tiny", dwell_time_seconds=1e-9),
    ]
    assert kept(events, rows) == ["max", "tiny"]


def test_required_ids(events):
    rows = [
        event(event_id="no_store", store_id=None),
        event(event_id="no_zone", zone_id=None),
        event(event_id=None),
        event(event_id=""),  # empty strings are not NULL: kept
        event(event_id="empty_store", store_id=""),
    ]
    assert kept(events, rows) == ["", "empty_store"]


def test_time_is_not_checked_unless_asked(events):
    rows = [event(event_id="no_time", timestamp=None), event(event_id="poison", timestamp=2**63 - 1)]
    assert kept(events, rows) == ["no_time", "poison"]
    assert kept(events, rows, require_event_time=True) == []


def test_custom_bounds(events):
    rows = [event(event_id=str(d), dwell_time_seconds=d) for d in (1.0, 10.0, 100.0)]
    assert kept(events, rows, min_dwell=1.0, max_dwell=50.0) == ["10.0"]


def test_columns_unchanged(events):
    df = events([event()])
    assert clean_sensor_events(df).schema == df.schema
