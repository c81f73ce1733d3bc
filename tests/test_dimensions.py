import datetime as dt

import pytest
from conftest import SF_SMALL, event
from pyspark.sql import functions as F

from footfall.operators.enrich import join_dimensions, with_event_time, with_local_time_flags
from footfall.schemas import STORES, ZONES
from footfall.sources.dimensions import stores_dimension, zones_dimension


def seeded_dims(spark):
    stores = spark.createDataFrame(
        [("OSL_07", "Oslo Harbour", "Oslo", "Norway", "Europe/Oslo", None),
         ("ROM_03", "Rome Station", "Rome", "Italy", "Europe/Rome", None)], STORES)
    zones = spark.createDataFrame(
        [("Z1", "OSL_07", "Row of teas", "Tea", None, None),
         ("Z2", "OSL_07", "Row of nuts", "Nuts", None, None),
         ("Z3", "ROM_03", "Lamp corner", "Lamps", None, None)], ZONES)
    return stores, zones


def test_left_join_keeps_unmatched(spark, events):
    stores, zones = seeded_dims(spark)
    ev = events([
        event(event_id="1", store_id="OSL_07", zone_id="Z1"),
        event(event_id="2", store_id="ROM_03", zone_id="ZONE_X"),  # zone unknown
        event(event_id="3", store_id="MAD_01", zone_id="ZONE_1"),  # store unknown
    ])
    out = {r.event_id: r for r in join_dimensions(ev, stores, zones).collect()}
    assert len(out) == 3
    assert (out["1"].store_name, out["1"].zone_name) == ("Oslo Harbour", "Row of teas")
    assert (out["2"].store_name, out["2"].zone_name) == ("Rome Station", None)
    assert (out["3"].store_name, out["3"].zone_name) == (None, None)


def test_dimension_join_is_broadcast(spark, events):
    stores, zones = stores_dimension(spark, SF_SMALL), zones_dimension(spark, SF_SMALL)  # sizes known from files
    df = join_dimensions(events([event()]), stores, zones)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_repeated_dimension_keys_count_once(spark, events):
    stores, zones = seeded_dims(spark)
    out = join_dimensions(events([event(store_id="OSL_07", zone_id="Z1")]), stores.unionByName(stores), zones.unionByName(zones))
    assert out.count() == 1


def test_unknown_time_zone_falls_back_to_utc(spark, events):
    stores, _ = seeded_dims(spark)
    bad = stores.withColumn("tz", F.lit("Mars/Olympus"))
    got = with_local_time_flags(with_event_time(events([event(store_id="OSL_07")])), bad).collect()
    assert [r.tz for r in got] == ["UTC"]


def test_local_time_flags(spark, events):
    stores, _ = seeded_dims(spark)
    # 2024-01-06 (Saturday) 23:30 UTC is Sunday 00:30 in Oslo;
    # 08:30 UTC is 09:30 in Oslo (peak) but 08:30 UTC (not peak) for an unknown store.
    sat_2330 = int(dt.datetime(2024, 1, 6, 23, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    mon_0830 = int(dt.datetime(2024, 1, 8, 8, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    ev = with_event_time(events([
        event(event_id="a", store_id="OSL_07", timestamp=sat_2330),
        event(event_id="b", store_id="OSL_07", timestamp=mon_0830),
        event(event_id="c", store_id="MAD_01", timestamp=mon_0830),
    ]))
    out = {r.event_id: r for r in with_local_time_flags(ev, stores).collect()}
    assert (out["a"].is_weekend_local, out["a"].is_peak_hour_local) == (True, False)
    assert (out["b"].is_weekend_local, out["b"].is_peak_hour_local) == (False, True)
    assert (out["c"].tz, out["c"].is_peak_hour_local) == ("UTC", False)


def test_derived_dimensions_have_unique_keys(spark):
    from conftest import SF_SMALL
    from footfall.sources.dimensions import stores_dimension, zones_dimension

    z = zones_dimension(spark, SF_SMALL)
    s = stores_dimension(spark, SF_SMALL)
    assert z.count() == z.select("store_id", "zone_id").distinct().count() == 25
    assert s.count() == s.select("store_id").distinct().count() == 5
    assert s.filter(F.col("tz").isNull()).count() == 0


def test_large_dimension_uses_salted_shuffle_join(spark, events):
    stores, zones = seeded_dims(spark)
    rows = [event(event_id=str(i), store_id="OSL_07", zone_id="Z1") for i in range(50)]
    rows += [event(event_id="x", store_id="MAD_01", zone_id="ZONE_1")]
    ev = events(rows)
    plain = {(r.event_id, r.store_name, r.zone_name) for r in join_dimensions(ev, stores, zones).collect()}
    salted_df = join_dimensions(ev, stores, zones, salted=True)
    salted = {(r.event_id, r.store_name, r.zone_name) for r in salted_df.collect()}
    assert salted == plain and len(salted) == 51
    assert salted_df.columns == join_dimensions(ev, stores, zones).columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = join_dimensions(ev, stores, zones, salted=True)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_salt" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_salt_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    from footfall.operators.joins import salted_left_join

    facts = spark.range(4000).select(F.col("id").cast("string").alias("event_id"), F.lit("HOT").alias("k"))
    dim = spark.createDataFrame([("HOT", "v")], "k string, attr string")
    out = salted_left_join(facts, dim, ["k"], buckets=16)
    assert out.filter("attr = 'v'").count() == 4000
    per_salt = facts.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(16))).count().collect()
    assert len(per_salt) == 16 and max(r["count"] for r in per_salt) < 4000 / 8


def test_jdbc_read_is_split_and_pushed():
    from footfall.sources.dimensions import jdbc_options

    plain = jdbc_options("jdbc:x", "shops", properties={"user": "u"})
    assert plain == {"user": "u", "url": "jdbc:x", "dbtable": "shops"}
    split = jdbc_options("jdbc:x", "shops", ["id", "city"], "open = 1", ("id", 10, 99, 4))
    assert split["dbtable"] == "(SELECT id, city FROM shops WHERE open = 1) chosen"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "10", "100", "4")
    for wrong in (("id", 9, 1, 4), ("id", 1, 9, 0), ("zip", 1, 9, 2)):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", "shops", ["id", "city"], None, wrong)
