"""As-of lookup: the version of a dimension row that was valid at a fact's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def asof_left_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    time_col: str = "event_time",
    valid_from: str = "valid_from",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Facts with the columns of the version of their key that is valid at
    ``time_col``: the one with the greatest ``valid_from`` at or before it. A
    version ends where the next one of its key begins.

    Facts and versions are merged by one sort per key, and the last version
    seen is carried along, so work does not grow with the versions of a key. A
    key of more than ``rows_per_task`` facts is split by a hash of the fact's
    columns into as many tasks as it needs, each of which gets that key's
    versions; such keys are at most ``facts / rows_per_task``, which bounds the
    list that is broadcast.

    Facts with a null key or time, or before the first version, are kept with
    nulls. Of versions that start at the same time the greatest counts (by the
    remaining columns, in their order); versions with a null key or start never
    do. Repeated facts stay repeated. No column but the keys may be in both."""
    rest = [c for c in versions.columns if c not in keys and c != valid_from]
    clash = set(facts.columns) & {valid_from, *rest}
    if clash:
        raise ValueError(f"columns of both facts and versions: {sorted(clash)}")
    sizes = facts.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(
        sizes.filter(F.col("_n") > rows_per_task).select(*keys, F.ceil(F.col("_n") / rows_per_task).alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = F.xxhash64(*facts.columns)
    without_key = F.greatest(F.lit(0), *[F.col(k).isNull().cast("int") for k in keys]) == 1
    f = facts.join(hot, keys, "left").select(
        *keys,
        F.when(without_key, spread).otherwise(F.pmod(spread, salts)).alias("_salt"),
        F.col(time_col).alias("_at"),
        F.struct(*facts.columns).alias("_fact"),
    )
    starts = versions.dropna(subset=[*keys, valid_from]).groupBy(*keys, F.col(valid_from).alias("_at"))
    v = starts.agg(F.max(F.struct(valid_from, *rest)).alias("_version")).join(hot, keys, "left")
    v = v.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
    both = v.unionByName(f, allowMissingColumns=True)
    merged = Window.partitionBy(*keys, "_salt").orderBy("_at", F.col("_fact").isNotNull())
    merged = merged.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = both.withColumn("_held", F.last("_version", ignorenulls=True).over(merged))
    return held.filter(F.col("_fact").isNotNull()).select("_fact.*", "_held.*")
