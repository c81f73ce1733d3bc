"""The current table: the change log folded, step by step, into one row per key.

Each fold reads the batches written since the last one and the dates they
touch, and writes those dates anew as ``generation=<n>/window_date=<d>``; other
dates stay where they are. A date is read from its newest generation. A
generation counts once its write has succeeded, so a fold that fails changes
nothing and is simply run again. Rows keep the run and batch they come from:
the greatest of the newest generation says how far the log is folded.

One fold runs at a time, and runs of the log follow one another (a run that
goes on writing after a later one has been folded is not seen).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.changelog import BATCH_ID, RUN
from footfall.schemas import TRAFFIC_KEY, TRAFFIC_STATS
from footfall.sinks.tables import folders, read_changelog, remove_folder

GENERATION = "generation"
WINDOW_DATE = "window_date"
COLUMNS = [f.name for f in TRAFFIC_STATS.fields]
STORED = [*COLUMNS, RUN, BATCH_ID]


def _generations(spark: SparkSession, path: str) -> list[str]:
    done = folders(spark, f"{path.rstrip('/')}/{GENERATION}=*/_SUCCESS")
    return sorted(p.split("/")[-2] for p in done)


def current_dates(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every date of the table (``yyyy-mm-dd``), by its newest generation."""
    root, newest = path.rstrip("/"), {}
    done = set(_generations(spark, path))
    for found in sorted(folders(spark, f"{root}/{GENERATION}=*/{WINDOW_DATE}=*")):
        generation, date = found.split("/")[-2:]
        if generation in done:
            newest[date.split("=", 1)[1]] = f"{root}/{generation}/{date}"
    return newest


def read_current(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Rows of the current table with ``window_date``; of some dates only, if
    given. Only their folders are listed and read."""
    held = current_dates(spark, path)
    paths = [p for d, p in held.items() if dates is None or d in dates]
    if not paths:
        schema = "window_start timestamp, window_end timestamp, store_id string, zone_id string, visitor_count long, total_dwell_time double, run string, batch_id long, window_date date"
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", path).parquet(*paths).select(*STORED, WINDOW_DATE)


def read_newest_date(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest date of the current table: all a live dashboard reads."""
    return read_current(spark, path, sorted(current_dates(spark, path))[-1:])


def _latest(rows: DataFrame) -> DataFrame:
    row = F.struct(RUN, BATCH_ID, "visitor_count", "total_dwell_time")
    latest = rows.groupBy(*TRAFFIC_KEY).agg(F.max_by(row, F.struct(RUN, BATCH_ID)).alias("s"))
    return latest.select(*TRAFFIC_KEY, "s.*")


def _mark(spark: SparkSession, path: str, generation: str):
    """The greatest (run, batch_id) of a generation: how far the log is folded."""
    last = spark.read.parquet(f"{path.rstrip('/')}/{generation}")
    return last.agg(F.max(F.struct(RUN, BATCH_ID)).alias("m")).first().m


def expire_folded(spark: SparkSession, changelog_path: str, path: str, keep: int = 2) -> list[str]:
    """Delete what folding has made superfluous and return the folders deleted:
    dates that had been replaced before the last ``keep`` folds (readers of the
    later ones go on undisturbed) and batches of the change log before the last
    folded one. After that the log alone no longer gives the current table."""
    done = _generations(spark, path)
    if not done:
        return []
    number = lambda generation: int(generation.split("=")[1])
    by_date: dict[str, list[str]] = {}
    for found in folders(spark, f"{path.rstrip('/')}/{GENERATION}=*/{WINDOW_DATE}=*"):
        if found.split("/")[-2] in done:
            by_date.setdefault(found.split("/")[-1], []).append(found)
    gone = []
    for held in by_date.values():
        held.sort()
        gone += [old for old, new in zip(held, held[1:]) if number(new.split("/")[-2]) <= number(done[-1]) - keep]
    mark = _mark(spark, path, done[-1])
    for found in folders(spark, f"{changelog_path.rstrip('/')}/{RUN}=*/{BATCH_ID}=*"):
        run, batch = (part.split("=", 1)[1] for part in found.split("/")[-2:])
        if (run, int(batch)) < (mark[RUN], mark[BATCH_ID]):
            gone.append(found)
    for folder in gone:
        remove_folder(spark, folder)
    return gone


def fold_changelog(spark: SparkSession, changelog_path: str, path: str) -> list[str]:
    """Fold what the change log gained since the last fold into the current
    table; returns the dates written anew (none, if nothing is new).

    The dates of the new rows come to the driver: one value a day."""
    log = read_changelog(spark, changelog_path)
    done = _generations(spark, path)
    if done:
        mark = _mark(spark, path, done[-1])
        later = (F.col(RUN) == mark[RUN]) & (F.col(BATCH_ID) > mark[BATCH_ID])
        log = log.filter((F.col(RUN) > mark[RUN]) | later)  # on folder names: older batches are not read
    log = log.select(*STORED)
    dates = sorted(str(r[0]) for r in log.select(F.to_date("window_start")).distinct().collect())
    if not dates:
        return []
    held = read_current(spark, path, dates).select(*STORED)
    number = int(done[-1].split("=")[1]) + 1 if done else 1
    (
        _latest(held.unionByName(log))
        .withColumn(WINDOW_DATE, F.to_date("window_start"))
        .hint("rebalance", WINDOW_DATE)
        .write.mode("overwrite")
        .partitionBy(WINDOW_DATE)
        .parquet(f"{path.rstrip('/')}/{GENERATION}={number:08d}")
    )
    return dates
