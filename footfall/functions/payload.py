"""Payload expressions: UTF-8 validity, JSON serialisation and parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schemas import CORRUPT_COLUMN, SENSOR_EVENT_FIELDS, SENSOR_EVENT_PARSE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_utf8(value: Column | str) -> Column:
    """Binary payload -> string (no validation; see ``is_utf8``)."""
    return _col(value).cast("string")


def is_utf8(value: Column | str) -> Column:
    """True when the binary payload is valid UTF-8. A NULL payload is not
    an encoding error (it is rejected later as empty)."""
    return F.coalesce(F.is_valid_utf8(decode_utf8(value)), F.lit(True))


def sensor_event_json(fields: list[str] | None = None) -> Column:
    """Serialise the sensor-event columns of the current row to JSON text.
    NULL fields are omitted, which parses back to NULL."""
    names = fields or SENSOR_EVENT_FIELDS
    return F.to_json(F.struct(*[F.col(n) for n in names]))


def parse_sensor_payload(text: Column | str) -> Column:
    """JSON text -> struct of the sensor-event fields plus the corrupt-record
    column. Permissive: malformed text gives NULL fields and the raw text in
    the corrupt column instead of failing the query."""
    return F.from_json(
        _col(text),
        SENSOR_EVENT_PARSE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
