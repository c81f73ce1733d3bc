"""Traffic rows clustered along a space-filling curve, with a range index.

Folders per (store, zone) give many small files and no pruning by time; files
per date give none by store. Here the bits of a row's rank by store, by zone
and by time are interleaved (a Z-order curve) and files are ranges of that
number, so each file spans few stores, few zones and little time. The least
and greatest value of every file are kept beside the data; a reader asks this
index first and opens only files that can hold a row it wants.

The index is one row per file. Each write is a version of the whole table with
an index of its own; readers take the newest version whose index is complete,
so a write that fails or is still at work changes nothing for them.
``expire_versions`` deletes earlier ones.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.schemas import TRAFFIC_STATS
from footfall.sinks.tables import TRAFFIC_COLUMNS, folders, remove_folder

BITS = 12  # of each dimension's rank
PLACE_COLUMNS = ("store_id", "zone_id")
TIME = "window_start"
ROWS_PER_FILE = 1_000_000
INDEX = "_index"
VERSION = "version"


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """Z-order number of whole-number ranks below ``2**bits``."""
    n = len(ranks)
    parts = [F.shiftleft(F.getbit(r, F.lit(b)).cast("long"), b * n + n - 1 - d) for b in range(bits) for d, r in enumerate(ranks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def _ranked(rows: DataFrame, column: str) -> DataFrame:
    """Rows with ``_rank_<column>``: the place of the value among the distinct
    ones, scaled to the curve's width. The distinct stores or zones, a
    dimension's rows, are ordered by one task."""
    distinct = rows.select(column).distinct()
    place = F.percent_rank().over(Window.orderBy(F.col(column).asc_nulls_first()))
    rank = F.floor(place * (2**BITS - 1)).cast("long").alias(f"_rank_{column}")
    ranks = distinct.select(F.col(column).alias("_value"), rank)
    return rows.join(ranks, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def write_clustered(rows: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write traffic rows (one per key) and their index; returns the number of
    files asked for. Rows without a window are kept, at the curve's begin."""
    spark = rows.sparkSession
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), F.unix_seconds(F.min(TIME)).alias("a"), F.unix_seconds(F.max(TIME)).alias("b")).first()
    files = max(1, -(-bounds.n // rows_per_file))
    first, span = bounds.a or 0, max(1, (bounds.b or 0) - (bounds.a or 0))
    at = F.coalesce(F.unix_seconds(TIME) - F.lit(first), F.lit(0))
    placed = rows.select(*TRAFFIC_COLUMNS).withColumn("_rank_time", F.floor(at * (2**BITS - 1) / F.lit(span)).cast("long"))
    for column in PLACE_COLUMNS:
        placed = _ranked(placed, column)
    curve = interleaved([F.col(c) for c in ("_rank_time", *(f"_rank_{c}" for c in PLACE_COLUMNS))])
    placed = placed.withColumn("_z", curve).select(*TRAFFIC_COLUMNS, "_z")
    name = f"{VERSION}={int(time.time() * 1000):013d}-{uuid.uuid4().hex}"
    version = f"{path.rstrip('/')}/{name}"
    placed.repartitionByRange(files, "_z", *PLACE_COLUMNS, TIME).sortWithinPartitions(*PLACE_COLUMNS, TIME).drop("_z").write.mode(
        "errorifexists"
    ).parquet(version)
    held = spark.read.schema(TRAFFIC_STATS).parquet(version)
    ranges = [e for c in (*PLACE_COLUMNS, TIME) for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    index = held.select("*", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *ranges)
    index.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{INDEX}/{name}")
    return files


def _versions(spark: SparkSession, path: str) -> list[str]:
    done = folders(spark, f"{path.rstrip('/')}/{INDEX}/{VERSION}=*/_SUCCESS")
    return sorted(p.split("/")[-2] for p in done)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` complete versions; returns their names."""
    gone = _versions(spark, path)[: -max(1, keep)]
    for name in gone:
        remove_folder(spark, f"{path.rstrip('/')}/{INDEX}/{name}")
        remove_folder(spark, f"{path.rstrip('/')}/{name}")
    return gone


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of the newest version: its rows and the least and
    greatest value of each column of the curve."""
    return spark.read.parquet(f"{path.rstrip('/')}/{INDEX}/{_versions(spark, path)[-1]}")


def newest_window(spark: SparkSession, path: str):
    """Start of the newest window, from the index alone (None, if empty)."""
    return file_index(spark, path).agg(F.max(f"max_{TIME}")).first()[0]


def pruned_files(spark: SparkSession, path: str, equal: dict[str, str] | None = None, since=None, until=None) -> list[str]:
    """Files that can hold rows of these places and of windows that start in
    ``[since, until]``."""
    index = file_index(spark, path)
    for column, value in (equal or {}).items():
        index = index.filter(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
    if since is not None:
        index = index.filter(F.col(f"max_{TIME}") >= F.lit(since))
    if until is not None:
        index = index.filter(F.col(f"min_{TIME}") <= F.lit(until))
    return sorted(r.file for r in index.select("file").collect())  # a listing of files, as any scan makes


def read_clustered(spark: SparkSession, path: str, equal: dict[str, str] | None = None, since=None, until=None) -> DataFrame:
    """Traffic rows of these places and times; only files that can hold one are opened."""
    files = pruned_files(spark, path, equal, since, until)
    rows = spark.read.schema(TRAFFIC_STATS).parquet(*files) if files else spark.createDataFrame([], TRAFFIC_STATS)
    for column, value in (equal or {}).items():
        rows = rows.filter(F.col(column) == value)
    if since is not None:
        rows = rows.filter(F.col(TIME) >= F.lit(since))
    return rows if until is None else rows.filter(F.col(TIME) <= F.lit(until))
