import json

from footfall.operators.parse import decode_envelope, forward_valid, parse_sensor_events
from footfall.operators.quality import accepted_events, classify_events
from footfall.schemas import ENVELOPE, SENSOR_EVENT_FIELDS

GOOD = {"event_id": "e1", "timestamp": 1704585600000, "store_id": "STORE_01", "zone_id": "ZONE_A",
        "sensor_id": "SENSOR_1", "age_range": "26-35", "gender": "male", "dwell_time_seconds": 5.0}


def envelope(spark, values):
    rows = [("sensors/x", b"sensors/x", v, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def j(**changes):
    d = dict(GOOD)
    d.update(changes)
    return json.dumps(d).encode()


def classify(spark, values):
    out = classify_events(decode_envelope(envelope(spark, values))).orderBy("offset").collect()
    return [r.reject_reason for r in out]


def test_valid_payload_parses_all_fields(spark):
    out = parse_sensor_events(envelope(spark, [j()]).selectExpr("cast(value as string) as payload"))
    assert out.columns == SENSOR_EVENT_FIELDS
    assert out.first().asDict() == GOOD


def test_reject_reasons_for_edge_payloads(spark):
    values = [
        j(),                                   # accepted
        b"\xff\xfe" + j(),                     # invalid_utf8
        b"",                                   # empty_payload
        None,                                  # empty_payload
        b"not json",                           # malformed_json
        b'[{"event_id": "x"}]',                # array root: malformed_json
        b'{"visitor_count": 10}',              # all fields NULL
        j(timestamp="1704585600000"),          # timestamp as string
        j(dwell_time_seconds="abc"),           # dwell as text
        j(store_id=None),
        j(zone_id=None),
        j(dwell_time_seconds=0.0),
        j(dwell_time_seconds=3600.5),
        j(timestamp=9223372036854775807),      # would throw when converted
        json.dumps({k.upper(): v for k, v in GOOD.items()}).encode(),  # keys are case-sensitive
        j(dwell_time_seconds="NaN"),
    ]
    assert classify(spark, values) == [
        None, "invalid_utf8", "empty_payload", "empty_payload", "malformed_json",
        "malformed_json", "missing_event_id", "malformed_json", "malformed_json",
        "missing_store_id", "missing_zone_id", "dwell_not_positive", "dwell_too_long",
        "bad_timestamp", "missing_event_id", "invalid_dwell_time",
    ]


def test_numbers_coerce_to_strings_and_unknown_keys_drop(spark):
    d = dict(GOOD, store_id=7, face_id="secret")
    df = decode_envelope(envelope(spark, [json.dumps(d).encode()]))
    row = accepted_events(classify_events(df)).first()
    assert row.store_id == "7"
    assert "face_id" not in df.columns


def test_accepted_plus_rejected_is_input(spark):
    values = [j(), b"\xff", b"x", j(store_id=None), j(event_id="e2")]
    df = classify_events(decode_envelope(envelope(spark, values)))
    acc = df.filter("reject_reason is null").count()
    rej = df.filter("reject_reason is not null").count()
    assert (acc, rej) == (2, 3)


def test_forwarder_gate(spark):
    env = envelope(spark, [b'{"visitor_count": 10}', b"\xff\xfe", None])
    assert forward_valid(env).count() == 2


def test_json_parsed_once(spark):
    env = envelope(spark, [j()])
    df = accepted_events(classify_events(decode_envelope(env)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
