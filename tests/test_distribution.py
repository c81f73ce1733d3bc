"""Sketched quantiles against exact ones; chi-square against a plain sum."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators.distribution import dwell_sketches, exact_ranks, merged_quantiles, rank_error, target_fit, within_rank_error

DEMO = "age_range string, gender string"


@pytest.fixture(scope="module")
def dwell(spark):
    rng = np.random.default_rng(8)
    rows = [("busy", float(x), n % 9) for n, x in enumerate(rng.exponential(10, 20_000))]
    rows += [("ties", float(x), n % 4) for n, x in enumerate(rng.integers(0, 3, 3_000))]
    rows += [("one", 7.0, 0), ("one", None, 0), ("one", float("nan"), 1), ("none", None, 0)]
    return spark.createDataFrame(rows, "store_id string, dwell_time_seconds double, day int").repartition(5).persist()


def test_merged_sketches_keep_the_bound(dwell):
    days = dwell_sketches(dwell, ["store_id", "day"])
    found = merged_quantiles(days, ["store_id"])
    asked = exact_ranks(dwell, found, "store_id").withColumn("ok", within_rank_error()).collect()
    assert len(asked) == 21 and all(r.ok for r in asked)
    exact = np.array([r.dwell_time_seconds for r in dwell.filter("store_id = 'busy'").collect()])
    for r in asked:
        if r.store_id == "busy":
            assert r.n_events == 20_000
            assert abs((exact <= r.dwell_time_seconds).mean() - r.probability) <= rank_error()
            assert r.upto == (exact <= r.dwell_time_seconds).mean() and r.below == (exact < r.dwell_time_seconds).mean()
    assert {r.dwell_time_seconds for r in asked if r.store_id == "one"} == {7.0}


def test_a_wrong_quantile_breaks_the_bound(dwell):
    found = merged_quantiles(dwell_sketches(dwell, ["store_id"]), ["store_id"])
    off = found.withColumn("dwell_time_seconds", F.col("dwell_time_seconds") * 1.5).filter("store_id = 'busy'")
    ranked = exact_ranks(dwell, off, "store_id").withColumn("ok", within_rank_error())
    assert not all(r.ok for r in ranked.filter("probability between 0.2 and 0.8").collect())


def test_target_fit(spark):
    targets = {"age_range": {"young": 0.5, "mid": 0.3, "old": 0.2}, "gender": {"x": 0.9, "y": 0.1}}
    rows = [("young", "x")] * 52 + [("mid", "x")] * 28 + [("old", "y")] * 20 + [(None, "y"), ("other", "z")]
    got = {r.dimension: r for r in target_fit(spark.createDataFrame(rows, DEMO).repartition(3), targets).collect()}
    age, gender = got["age_range"], got["gender"]
    assert (age.n_events, age.n_outside, age.degrees, age.fits) == (100, 2, 2, True)
    assert age.chi_square == pytest.approx(4 / 50 + 4 / 30, abs=1e-4)
    assert (gender.n_events, gender.n_outside, gender.fits) == (101, 1, False)
    assert gender.chi_square == pytest.approx((80 - 90.9) ** 2 / 90.9 + (21 - 10.1) ** 2 / 10.1, abs=1e-4)


def test_target_fit_without_events(spark):
    rows = target_fit(spark.createDataFrame([], DEMO)).collect()
    assert [(r.n_events, r.n_outside, r.chi_square, r.fits) for r in rows] == [(0, 0, None, None)] * 2
