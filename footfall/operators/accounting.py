"""Proof that a bus was read without gap or overlap, and that nothing was lost
between read and written.

Offsets are cut into blocks; within a block, runs of consecutive offsets are
the groups of equal ``offset - rank``. Intervals of neighbouring blocks are then
compared with what lies before them, interval by interval, so the ordering
never covers more than a block's offsets or a partition's intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20  # offsets a block spans
BUS = ["topic", "partition"]


def offset_intervals(records: DataFrame, by: list[str], offset_col: str = "offset", block: int = BLOCK) -> DataFrame:
    """Runs of consecutive offsets per ``by`` that came equally often:
    ``first_offset``, ``last_offset`` and ``n_records``. Runs end at block
    borders. Null offsets take no part."""
    blocked = records.filter(F.col(offset_col).isNotNull()).withColumn("_block", F.floor(F.col(offset_col) / block))
    distinct = blocked.groupBy(*by, "_block", offset_col).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*by, "_block", "_n").orderBy(offset_col))
    runs = distinct.withColumn("_run", F.col(offset_col) - rank)
    return runs.groupBy(*by, "_block", "_n", "_run").agg(
        F.min(offset_col).alias("first_offset"), F.max(offset_col).alias("last_offset"), F.sum("_n").alias("n_records")
    ).drop("_block", "_n", "_run")


def audit_intervals(intervals: DataFrame, by: list[str]) -> DataFrame:
    """Gaps and overlaps among the intervals of each ``by``: ``kind``,
    ``first_offset`` and ``last_offset`` of what is missing, or delivered more
    than once. An interval is compared with the furthest offset before it.

    Intervals are what a batch adds to a partition: a few each, so a
    partition's window stays small."""
    order = Window.partitionBy(*by).orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    seen = intervals.withColumn("_before", before)
    gap = F.col("first_offset") > F.col("_before") + 1
    overlap = F.col("first_offset") <= F.col("_before")
    length = F.col("last_offset") - F.col("first_offset") + 1
    again = intervals.filter(F.col("n_records") > length).select(*by, F.lit("overlap").alias("kind"), "first_offset", "last_offset")
    found = seen.select(
        *by,
        F.when(gap, F.lit("gap")).when(overlap, F.lit("overlap")).alias("kind"),
        F.when(gap, F.col("_before") + 1).otherwise(F.col("first_offset")).alias("first_offset"),
        F.when(gap, F.col("first_offset") - 1).otherwise(F.least("last_offset", "_before")).alias("last_offset"),
    )
    return found.filter(F.col("kind").isNotNull()).unionByName(again)


def merged_findings(findings: DataFrame, by: list[str]) -> DataFrame:
    """Findings of one kind that touch, as one."""
    order = Window.partitionBy(*by, "kind").orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("first_offset") > before + 1), 1).otherwise(0)
    numbered = findings.withColumn("_starts", starts).withColumn("_island", F.sum("_starts").over(order))
    return numbered.groupBy(*by, "kind", "_island").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
    ).drop("_island")


def unbalanced(accounts: DataFrame) -> DataFrame:
    """Batches whose accepted, rejected and late records do not add up to those read."""
    return accounts.filter(F.col("accepted") + F.col("rejected") + F.col("late") != F.col("read"))
