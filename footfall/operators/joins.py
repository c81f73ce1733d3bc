"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_row_per_key(dim: DataFrame, keys: list[str]) -> DataFrame:
    """``dim`` with one row per key (the smallest), so a key that repeats in an
    unconstrained source cannot multiply the facts."""
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return dim.select(*keys).distinct()
    return dim.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")


def salted_left_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    buckets: int | None = None,
    salt_col: str | None = "event_id",
) -> DataFrame:
    """Left join on ``keys`` that spreads each key over ``buckets`` tasks.

    ``buckets`` is the number of shuffle partitions unless given.
    For a dimension too large to broadcast when one key (a busy store) may
    carry a third of the facts and adaptive skew handling is not available
    (streaming micro-batches run without AQE). Each fact gets a salt from a
    hash of ``salt_col`` (deterministic, so a retried task sees the same
    salt); each dimension row is repeated once per salt value. The result
    equals a plain left join.
    """
    salt = "_salt"
    buckets = buckets or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if salt_col and salt_col in facts.columns:
        s = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(buckets))
    else:
        s = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(buckets))
    f = facts.withColumn(salt, s.cast("int"))
    d = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return f.join(d, on=[*keys, salt], how="left").drop(salt)
