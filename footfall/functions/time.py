"""Event-time expressions.

All flags are NULL-safe in the same way as the original job: an event
without a usable time is *not* peak and *not* weekend (False, not NULL).
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.fixed import PEAK_END_HOUR, PEAK_START_HOUR, WEEKEND_DAYS

# The calendar range Spark timestamps can hold,
# 0001-01-01T00:00:00Z .. 9999-12-31T23:59:59.999Z, in epoch milliseconds.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_epoch_millis(ms: Column | str) -> Column:
    """True when ``ms`` is non-NULL and converts to a timestamp.

    With ANSI mode on, converting an out-of-range value throws, and one
    poison event would fail the whole stream; guard before converting.
    """
    c = _col(ms)
    return F.coalesce(c.between(MIN_EPOCH_MS, MAX_EPOCH_MS), F.lit(False))


def event_time_from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP (exact), NULL when unusable."""
    c = _col(ms)
    return F.when(valid_epoch_millis(c), F.timestamp_millis(c))


def in_hour_range(
    ts: Column | str, start_hour: int = PEAK_START_HOUR, end_hour: int = PEAK_END_HOUR
) -> Column:
    """Half-open hour range [start_hour, end_hour) of ``ts``; NULL -> False."""
    h = F.hour(_col(ts))
    return F.coalesce((h >= start_hour) & (h < end_hour), F.lit(False))


def is_weekend(ts: Column | str) -> Column:
    """Saturday or Sunday (dayofweek 1=Sunday .. 7=Saturday); NULL -> False."""
    return F.coalesce(F.dayofweek(_col(ts)).isin(*WEEKEND_DAYS), F.lit(False))


def known_zone(tz: Column | str) -> Column:
    """True when ``tz`` names an IANA zone or a fixed offset; NULL -> False."""
    c = _col(tz)
    return F.coalesce(c.isin(*sorted(available_timezones())) | c.rlike(r"^[+-](0\d|1[0-7]):[0-5]\d$"), F.lit(False))


def local_time(ts: Column | str, tz: Column | str) -> Column:
    """Wall-clock time of the instant ``ts`` in the IANA zone ``tz`` (per row)."""
    return F.from_utc_timestamp(_col(ts), _col(tz))
