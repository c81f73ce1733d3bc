"""The as-of lookup against a plain walk over the versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators.asof import asof_left_join

FACTS = "id long, store_id string, event_time timestamp"
VERSIONS = "store_id string, valid_from timestamp, version long, tenant string"
START = dt.datetime(2031, 5, 6)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def walk(facts, versions):
    out = []
    for i, store, when in facts:
        held = [v for v in versions if None not in (store, when, v[0], v[1]) and v[0] == store and v[1] <= when]
        best = max(held, key=lambda v: (v[1], v[2]), default=(None,) * 4)
        out.append((i, store, when, *best[1:]))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows_per_task", [3, 1_000_000])
def test_equals_a_walk(spark, rows_per_task):
    rnd = random.Random(4)
    facts = [(i, rnd.choice(["hot", "hot", "hot", "cold", "unknown", None]), at(rnd.choice([None, *range(40)]))) for i in range(120)]
    facts += facts[:30]  # repeated rows
    versions = [(rnd.choice(["hot", "cold", "idle", None]), at(rnd.choice([None, *range(5, 40, 3)])), n, f"t{n}") for n in range(30)]
    joined = asof_left_join(
        spark.createDataFrame(facts, FACTS).repartition(3), spark.createDataFrame(versions, VERSIONS), ["store_id"],
        rows_per_task=rows_per_task,
    )
    assert joined.columns == ["id", "store_id", "event_time", "valid_from", "version", "tenant"]
    assert rows(joined) == walk(facts, versions)


def test_empty_tables_and_clashing_columns(spark):
    facts = spark.createDataFrame([(1, "a", at(1))], FACTS)
    versions = spark.createDataFrame([("a", at(0), 7, "t")], VERSIONS)
    assert rows(asof_left_join(facts, versions.limit(0), ["store_id"])) == [(1, "a", at(1), None, None, None)]
    assert rows(asof_left_join(facts.limit(0), versions, ["store_id"])) == []
    with pytest.raises(ValueError, match="tenant"):
        asof_left_join(facts.withColumn("tenant", F.lit("x")), versions, ["store_id"])


def test_hot_key_is_split(spark):
    """A key of 400 facts is merged in pieces of about 40."""
    facts = spark.range(400).select(F.col("id"), F.lit("a").alias("store_id"), F.lit(at(9)).alias("event_time"))
    versions = spark.createDataFrame([("a", at(0), 7, "t")], VERSIONS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        split = asof_left_join(facts, versions, ["store_id"], rows_per_task=40)
        sizes = [r[1] for r in split.groupBy(F.spark_partition_id()).agg(F.count("version")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 400 and len(sizes) > 4 and max(sizes) < 200
