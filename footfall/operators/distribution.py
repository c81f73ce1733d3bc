"""Dwell-time quantiles from mergeable sketches, and the fit of demographics to their target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.fixed import CHI_SQUARE_999, TARGET_SHARES

SKETCH_K = 400
PROBABILITIES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


def rank_error(k: int = SKETCH_K) -> float:
    """How far a quantile's rank may lie from the one asked for, as a share of
    the rows: three times the published 99 % error of a sketch of this size."""
    return 3 * 2.296 / k**0.9723


def dwell_sketches(events: DataFrame, by: list[str], k: int = SKETCH_K, col: str = "dwell_time_seconds") -> DataFrame:
    """One KLL sketch of the dwell times per group, built by each task and
    merged: a few kilobytes a group move, whatever its rows. Missing and NaN
    times take no part."""
    known = events.filter(F.col(col).isNotNull() & ~F.isnan(col))
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(col, F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str], probabilities: tuple[float, ...] = PROBABILITIES) -> DataFrame:
    """Quantiles of coarser groups, from stored sketches alone: per group and
    probability the dwell time and ``n_events``."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    at = F.array(*[F.lit(p) for p in probabilities])
    pairs = F.arrays_zip(at.alias("probability"), F.kll_sketch_get_quantile_double("_s", at).alias("dwell_time_seconds"))
    found = merged.select(*by, F.kll_sketch_get_n_double("_s").alias("n_events"), F.explode(pairs).alias("_q"))
    return found.select(*by, F.col("_q.probability"), F.col("_q.dwell_time_seconds"), "n_events")


def exact_ranks(
    events: DataFrame, quantiles: DataFrame, by: str, probabilities: tuple[float, ...] = PROBABILITIES,
    col: str = "dwell_time_seconds",
) -> DataFrame:
    """``quantiles`` (of these probabilities) with the share of events below them and not above them.

    The quantiles of a group are one row beside its events, so an event is
    compared in place and a task emits one partial row per group."""
    asked = F.sort_array(F.collect_list(F.struct("probability", col)))  # as many as were asked for
    wide = quantiles.groupBy(by).agg(asked.alias("_asked"), F.max("n_events").alias("n_events"))
    count = len(probabilities)
    value = lambda i: F.col("_asked")[i][col]
    sums = [s for i in range(count) for s in (
        F.count_if(F.col("_d") < value(i)).alias(f"_below{i}"), F.count_if(F.col("_d") <= value(i)).alias(f"_upto{i}"))]
    held = events.select(by, F.col(col).alias("_d")).filter(F.col("_d").isNotNull() & ~F.isnan("_d"))
    counted = held.join(wide, by).groupBy(by).agg(F.first("_asked").alias("_asked"), F.first("n_events").alias("n_events"), *sums)
    rows = F.array(*[
        F.struct(F.col("_asked")[i]["probability"].alias("probability"), value(i).alias(col),
                 (F.col(f"_below{i}") / F.col("n_events")).alias("below"), (F.col(f"_upto{i}") / F.col("n_events")).alias("upto"))
        for i in range(count)
    ])
    return counted.select(by, "n_events", F.inline(rows))


def within_rank_error(k: int = SKETCH_K) -> Column:
    """Whether a row of ``exact_ranks`` keeps the bound."""
    e = F.lit(rank_error(k))
    return (F.col("below") <= F.col("probability") + e) & (F.col("upto") >= F.col("probability") - e)


def target_fit(events: DataFrame, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Pearson's chi-square of each demographic column against its target
    shares: one row per column with ``n_events`` (of known values),
    ``n_outside`` (null or no target), ``chi_square``, ``degrees`` and ``fits``
    (not rejected at 0.001; null without events).

    Events are reduced to one row per combination of known values first, of
    which there are as many as the targets allow."""
    targets = targets or TARGET_SHARES
    known = [F.when(F.col(c).isin(*shares), F.col(c)).alias(c) for c, shares in targets.items()]
    counts = events.select(*known).groupBy(*targets).agg(F.count(F.lit(1)).alias("_n"))
    of = lambda column, value: F.coalesce(F.sum(F.when(F.col(column) == value, F.col("_n"))), F.lit(0))
    sums = [of(c, v).alias(f"{c}_{i}") for c, shares in targets.items() for i, v in enumerate(shares)]
    totals = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"), *sums)
    rows = []
    for c, shares in targets.items():
        seen = [F.col(f"{c}_{i}") for i in range(len(shares))]
        n = sum(seen[1:], seen[0])
        parts = [F.try_divide((o - n * w) * (o - n * w), n * F.lit(w)) for o, w in zip(seen, shares.values())]
        chi, degrees = sum(parts[1:], parts[0]), len(shares) - 1
        rows.append(F.struct(
            F.lit(c).alias("dimension"), n.alias("n_events"), (F.col("_all") - n).alias("n_outside"),
            F.round(chi, 4).alias("chi_square"), F.lit(degrees).alias("degrees"), (chi <= CHI_SQUARE_999[degrees]).alias("fits"),
        ))
    return totals.select(F.inline(F.array(*rows)))
