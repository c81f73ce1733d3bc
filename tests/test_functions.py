import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from footfall.functions.time import (
    MAX_EPOCH_MS,
    MIN_EPOCH_MS,
    event_time_from_millis,
    in_hour_range,
    local_time,
    valid_epoch_millis,
)


def test_epoch_guard_boundaries(spark):
    vals = [MIN_EPOCH_MS - 1, MIN_EPOCH_MS, 0, MAX_EPOCH_MS, MAX_EPOCH_MS + 1, None]
    df = spark.createDataFrame([(v,) for v in vals], "ms long")
    out = df.select(valid_epoch_millis("ms").alias("ok"),
                    F.unix_millis(event_time_from_millis("ms")).alias("back")).collect()
    assert [r.ok for r in out] == [False, True, True, True, False, False]
    assert [r.back for r in out] == [None, MIN_EPOCH_MS, 0, MAX_EPOCH_MS, None, None]


def test_local_time_across_dst(spark):
    # Every 30 minutes across the 2024 spring-forward and fall-back days in New York and Berlin.
    starts = [dt.datetime(2024, 3, 10, tzinfo=dt.timezone.utc), dt.datetime(2024, 10, 27, tzinfo=dt.timezone.utc),
              dt.datetime(2024, 11, 3, tzinfo=dt.timezone.utc)]
    instants = [s + dt.timedelta(minutes=30 * i) for s in starts for i in range(48)]
    rows = [(int(t.timestamp() * 1000), tz) for t in instants for tz in ("America/New_York", "Europe/Berlin")]
    df = spark.createDataFrame(rows, "ms long, tz string")
    lt = local_time(event_time_from_millis("ms"), F.col("tz"))
    out = df.select("ms", "tz", F.hour(lt).alias("h"), F.minute(lt).alias("m"),
                    in_hour_range(lt).alias("peak")).collect()
    for r in out:
        want = dt.datetime.fromtimestamp(r.ms / 1000, ZoneInfo(r.tz))
        assert (r.h, r.m) == (want.hour, want.minute), (r.ms, r.tz)
        assert r.peak == (9 <= want.hour < 18)
