import math

from conftest import event

from footfall.operators.quality import demographics, quality_profile, unknown_store_zones
from footfall.schemas import ZONES


def test_profile(events):
    rows = [
        event(event_id="a", dwell_time_seconds=10.0),
        event(event_id="a", dwell_time_seconds=20.0),
        event(event_id="b", dwell_time_seconds=40.0, age_range="old", gender=None),
        event(event_id=None, store_id=None, dwell_time_seconds=-1.0),
        event(event_id="c", zone_id=None, dwell_time_seconds=math.nan),
    ]
    p = quality_profile(events(rows)).first()
    assert p.n_events == 5
    assert p.n_distinct_event_ids == 3
    assert p.n_duplicate_event_ids == 1
    assert (p.n_missing_event_id, p.n_missing_store_id, p.n_missing_zone_id) == (1, 1, 1)
    assert (p.n_bad_age_range, p.n_bad_gender) == (1, 1)
    assert p.n_dwell_out_of_domain == 2
    assert p.mean_dwell_seconds == round(70 / 3, 4)
    assert p.share_dwell_under_30s == 2 / 3


def test_demographics(events):
    rows = [event(age_range="18-25", gender="male")] * 3 + [event(age_range="over_50", gender="female")]
    out = {(r.age_range, r.gender): (r.n_events, r.share) for r in demographics(events(rows)).collect()}
    assert out == {("18-25", "male"): (3, 0.75), ("over_50", "female"): (1, 0.25)}


def test_unknown_store_zones(spark, events):
    zones = spark.createDataFrame([("ZONE_A", "ZRH_01", "a", "x", None, None)], ZONES)
    rows = [event(store_id="ZRH_01", zone_id="ZONE_A"), event(store_id="ZRH_01", zone_id="ZONE_Z"),
            event(store_id="MAD_01", zone_id="ZONE_A"), event(store_id=None, zone_id="ZONE_A"),
            event(store_id=None, zone_id="ZONE_A")]
    out = {(r.store_id, r.zone_id): r.n_events for r in unknown_store_zones(events(rows), zones).collect()}
    assert out == {("ZRH_01", "ZONE_Z"): 1, ("MAD_01", "ZONE_A"): 1, (None, "ZONE_A"): 2}


def test_profile_approximate_distinct(spark):
    from pyspark.sql import functions as F

    df = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("event_id"),
                                   F.lit(None).cast("long").alias("timestamp"),
                                   F.lit("S").alias("store_id"), F.lit("Z").alias("zone_id"),
                                   F.lit(None).cast("string").alias("sensor_id"),
                                   F.lit("18-25").alias("age_range"), F.lit("male").alias("gender"),
                                   F.lit(5.0).alias("dwell_time_seconds"))
    exact = quality_profile(df).first()
    approx = quality_profile(df, exact_distinct=False, rsd=0.02).first()
    assert exact.n_distinct_event_ids == 5000
    assert abs(approx.n_distinct_event_ids - 5000) <= 5000 * 0.06
    plan = quality_profile(df, exact_distinct=False)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_id" not in plan
