import datetime as dt
import math
import random

from pyspark.sql import functions as F

from footfall.operators.aggregate import aggregate_traffic, aggregate_traffic_exact

SCHEMA = "event_time timestamp, store_id string, zone_id string, dwell_time_seconds double"


def utc(*a):
    return dt.datetime(*a, tzinfo=dt.timezone.utc)


def rows_of(df):
    return sorted(
        df.select(
            F.date_format("window_start", "HH:mm:ss").alias("s"),
            F.date_format("window_end", "HH:mm:ss").alias("e"),
            "store_id", "zone_id", "visitor_count", "total_dwell_time",
        ).collect()
    )


def test_two_events_one_window(spark):
    df = spark.createDataFrame(
        [(utc(2023, 11, 3, 17, 41, 12), "kiosk", "entrance", 31.25),
         (utc(2023, 11, 3, 17, 44, 58), "kiosk", "entrance", 2.5)], SCHEMA)
    out = rows_of(aggregate_traffic(df))
    assert [tuple(r) for r in out] == [("17:40:00", "17:45:00", "kiosk", "entrance", 2, 33.75)]


def test_group_per_store_zone(spark):
    places = [("kiosk", "entrance"), ("kiosk", "till"), ("depot", "till"), (None, "till"), ("depot", None)]
    df = spark.createDataFrame([(utc(2023, 11, 3, 17, 40 + i % 2, i), *p, float(i)) for i, p in enumerate(places * 2)], SCHEMA)
    out = aggregate_traffic(df).collect()
    assert sorted(((r.store_id, r.zone_id, r.visitor_count, r.total_dwell_time) for r in out), key=str) == sorted(
        ((*p, 2, 2.0 * i + 5) for i, p in enumerate(places)), key=str)


def test_window_boundary_and_null_time(spark):
    df = spark.createDataFrame(
        [(utc(2023, 11, 3, 10, 4, 59, 999000), "S", "Z", 1.0),
         (utc(2023, 11, 3, 10, 5, 0), "S", "Z", 2.0),
         (None, "S", "Z", 4.0)], SCHEMA)
    out = rows_of(aggregate_traffic(df))
    assert [(r.s, r.visitor_count, r.total_dwell_time) for r in out] == [
        ("10:00:00", 1, 1.0), ("10:05:00", 1, 2.0)]


def test_configurable_window(spark):
    df = spark.createDataFrame(
        [(utc(2023, 11, 3, 10, 1), "S", "Z", 1.0), (utc(2023, 11, 3, 10, 14), "S", "Z", 1.0)], SCHEMA)
    out = rows_of(aggregate_traffic(df, "15 minutes"))
    assert [(r.s, r.e, r.visitor_count) for r in out] == [("10:00:00", "10:15:00", 2)]


def test_output_schema(spark):
    df = spark.createDataFrame([(utc(2023, 11, 3, 10, 0), "S", "Z", 1.0)], SCHEMA)
    out = aggregate_traffic(df)
    assert out.columns == ["window_start", "window_end", "store_id", "zone_id",
                           "visitor_count", "total_dwell_time"]
    assert out.schema["visitor_count"].dataType.simpleString() == "bigint"


def exact(df, n):
    out = aggregate_traffic_exact(df.repartition(n)).orderBy("store_id", "zone_id").collect()
    return [(r.store_id, r.visitor_count, r.total_dwell_time.hex()) for r in out]


def test_exact_sums_have_the_same_bits_in_any_order(spark):
    rng = random.Random(4)
    rows = [(utc(2023, 11, 3, 9, 1), rng.choice("ab"), "z", rng.choice([rng.uniform(0, 3600), rng.random() * 1e-6, 3600.0])) for _ in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = exact(df, 1)
    assert all(exact(df, n) == got for n in (3, 40, 200))
    for store, n, bits in got:
        own = [r[3] for r in rows if r[1] == store]
        assert n == len(own) and 0 <= math.fsum(own) - float.fromhex(bits) <= n * 2.0**-32 + 1e-9


def test_exact_sums_of_odd_dwell_times(spark):
    t = utc(2023, 11, 3, 9, 1)
    rows = [(t, s, "z", v) for s, v in [("a", None), ("a", float("nan")), ("a", float("inf")), ("a", 1.5), ("b", -2.25), ("b", 0.5), ("c", None)]]
    got = {r.store_id: (r.visitor_count, r.total_dwell_time) for r in aggregate_traffic_exact(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a": (4, 1.5), "b": (2, -1.75), "c": (1, None)}
