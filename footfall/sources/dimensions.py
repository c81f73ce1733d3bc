"""Store and zone dimension tables.

In production the dimensions live in a relational database and are read
with JDBC (``read_jdbc_dimension``). Offline they are derived from the
driver's fixed-size ``region`` (5 rows -> stores) and ``nation`` (25 rows ->
zones) tables, so their size does not grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.sources.tables import read_table

# IANA time zone of the stores of each region.
REGION_TZ = {
    "AFRICA": "Africa/Johannesburg",
    "AMERICA": "America/New_York",
    "ASIA": "Asia/Tokyo",
    "EUROPE": "Europe/Zurich",
    "MIDDLE EAST": "Asia/Dubai",
}
DEFAULT_TZ = "UTC"


def store_id_for(key) -> F.Column:
    """Store id of region / nation-region key ``k``: ``STORE_{k+1:02d}``."""
    return F.format_string("STORE_%02d", key + 1)


def _tz_of(region_name: F.Column) -> F.Column:
    tz_map = F.create_map(*[x for kv in REGION_TZ.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.element_at(tz_map, region_name), F.lit(DEFAULT_TZ))


def stores_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store per region: store_id, store_name, city, country, tz, created_at."""
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return r.select(
        store_id_for(F.col("r_regionkey")).alias("store_id"),
        F.concat(F.col("r_name"), F.lit(" store")).alias("store_name"),
        F.lit(None).cast("string").alias("city"),
        F.col("r_name").alias("country"),
        _tz_of(F.col("r_name")).alias("tz"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def zones_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per nation, in the store of the nation's region; the zone
    letter is the nation's rank inside its region (A, B, ...)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    rank = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    return n.select(
        F.concat(F.lit("ZONE_"), F.char(F.lit(64) + rank)).alias("zone_id"),
        store_id_for(F.col("n_regionkey")).alias("store_id"),
        F.col("n_name").alias("zone_name"),
        F.col("n_name").alias("product_category"),
        F.lit(None).cast("decimal(10,2)").alias("area_sqm"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


CAMPAIGN_HOURS = 720  # campaigns start within this many hours of CAMPAIGN_EPOCH
CAMPAIGN_EPOCH = "2024-01-01 00:00:00"


def store_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the stores: the campaign each runs from ``valid_from`` on, one
    version per customer row (several may start in the same hour)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    hours = F.col("c_custkey") * 7919 % CAMPAIGN_HOURS
    start = F.unix_seconds(F.lit(CAMPAIGN_EPOCH).cast("timestamp")) + hours * 3600
    return c.select(
        store_id_for(F.col("c_custkey") % 3).alias("store_id"),
        F.timestamp_seconds(start).alias("valid_from"),
        F.col("c_custkey").cast("long").alias("version"),
        F.col("c_mktsegment").alias("campaign"),
    )


def jdbc_options(
    url: str,
    table: str,
    columns: list[str] | None = None,
    where: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read. ``columns`` and ``where`` (SQL of the database)
    are put into the query it runs. ``split`` names a numeric column, its least
    and greatest value and a number of tasks: each task reads a range of it,
    rows beyond the bounds and nulls included, so the bounds decide how evenly
    the work is spread and never which rows are read."""
    source = table
    if columns or where:
        chosen = ", ".join(columns) if columns else "*"
        source = f"(SELECT {chosen} FROM {table}{f' WHERE {where}' if where else ''}) chosen"
    options = {**(properties or {}), "url": url, "dbtable": source}
    if split:
        column, least, greatest, tasks = split
        if tasks < 1 or greatest < least:
            raise ValueError("split needs a task and bounds in order")
        if columns and column not in columns:
            raise ValueError(f"the split column {column} is not read")
        options |= {
            "partitionColumn": column, "lowerBound": str(least), "upperBound": str(greatest + 1), "numPartitions": str(tasks),
        }
    return options


def read_jdbc_dimension(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    columns: list[str] | None = None,
    where: str | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Read a dimension table from a relational database (needs its driver jar);
    see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, columns, where, split, properties)).load()
