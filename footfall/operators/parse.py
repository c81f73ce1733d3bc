"""Envelope decoding: UTF-8 gate and a single-pass JSON parse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.payload import decode_utf8, is_utf8, parse_sensor_payload
from footfall.schemas import CORRUPT_COLUMN, SENSOR_EVENT_FIELDS

PAYLOAD = "payload"
UTF8_VALID = "utf8_valid"
BUS_TIME = "bus_time"


def utf8_gate(envelope: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``payload`` (the value as text) and ``utf8_valid``.

    Rows are not removed here: ``classify_events`` turns an invalid payload
    into a reject reason so it can be counted and dead-lettered.
    """
    return envelope.withColumn(PAYLOAD, decode_utf8(value_col)).withColumn(
        UTF8_VALID, is_utf8(value_col)
    )


def forward_valid(envelope: DataFrame, value_col: str = "value") -> DataFrame:
    """Forwarder behaviour: keep only records whose value is valid UTF-8."""
    return envelope.filter(is_utf8(value_col))


def parse_sensor_events(
    df: DataFrame,
    text_col: str = PAYLOAD,
    carry: list[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Parse JSON text into the 8 sensor-event columns (plus ``carry`` columns).

    The parse is wrapped in ``inline(array(...))``: a generator is a barrier
    the optimizer does not inline through, so the JSON is parsed once per
    row instead of once per downstream predicate that references a field.
    Malformed text yields NULL fields (and the raw text in the corrupt column
    when ``keep_corrupt``); unknown keys are dropped.
    """
    carry = list(carry or [])
    parsed = df.select(*carry, F.inline(F.array(parse_sensor_payload(text_col))))
    if keep_corrupt:
        return parsed
    return parsed.select(*carry, *SENSOR_EVENT_FIELDS)


def decode_envelope(envelope: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """UTF-8 gate + parse in one projection; keeps ``utf8_valid``, the payload
    and the corrupt-record column for reject classification.

    The envelope's arrival time (``timestamp``) is renamed ``bus_time`` so it
    cannot clash with the event's own ``timestamp`` field; list ``bus_time``
    in ``carry`` to keep it."""
    carry = list(carry if carry is not None else ["topic", "offset"])
    if "timestamp" in envelope.columns:
        envelope = envelope.withColumnRenamed("timestamp", BUS_TIME)
    gated = utf8_gate(envelope)
    return parse_sensor_events(
        gated, PAYLOAD, carry=carry + [UTF8_VALID, PAYLOAD], keep_corrupt=True
    )


__all__ = [
    "CORRUPT_COLUMN",
    "PAYLOAD",
    "UTF8_VALID",
    "decode_envelope",
    "forward_valid",
    "parse_sensor_events",
    "utf8_gate",
]
