"""Column-level building blocks (all built-in Spark expressions)."""

from footfall.functions.time import (
    MAX_EPOCH_MS,
    MIN_EPOCH_MS,
    event_time_from_millis,
    in_hour_range,
    is_weekend,
    known_zone,
    local_time,
    valid_epoch_millis,
)
from footfall.functions.payload import (
    decode_utf8,
    is_utf8,
    parse_sensor_payload,
    sensor_event_json,
)

__all__ = [
    "MAX_EPOCH_MS",
    "MIN_EPOCH_MS",
    "decode_utf8",
    "event_time_from_millis",
    "in_hour_range",
    "is_utf8",
    "is_weekend",
    "known_zone",
    "local_time",
    "parse_sensor_payload",
    "sensor_event_json",
    "valid_epoch_millis",
]
