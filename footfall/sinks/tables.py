"""Table sinks for the traffic result.

The change log is partitioned by ``run`` and ``batch_id``. A run is a streaming
query with its checkpoint: batch ids start again at 0 with a new checkpoint, so
a batch is only identified within its run. Writing a batch overwrites its own
folder, so a micro-batch that is re-run after a failure replaces its earlier
output instead of appending it a second time, and another run's output stays.
Run names begin with the time of the run's first batch, so later runs sort later.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.functions.payload import sensor_event_json
from footfall.operators.changelog import BATCH_ID, RUN, latest_per_key
from footfall.operators.parse import forward_valid
from footfall.schemas import TRAFFIC_STATS

log = logging.getLogger(__name__)

TRAFFIC_COLUMNS = [f.name for f in TRAFFIC_STATS.fields]

CHANGELOG = StructType(list(TRAFFIC_STATS.fields)).add(RUN, "string").add(BATCH_ID, "long")

BATCH_RUN = "0000000000000-batch"  # of logs that no streaming query writes


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system it names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    listed = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return [s.getPath().toString() for s in listed or []]


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, and those above it, unless it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run_of(batch: DataFrame, path: str) -> str:
    """Name of the run a micro-batch belongs to: the one its streaming query
    (whose id lives in the checkpoint) already uses under ``path``, or a new one."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        return BATCH_RUN
    names = sorted(p.rsplit("/", 1)[-1] for p in folders(spark, f"{path.rstrip('/')}/{RUN}=*-{query}"))
    return names[0].split("=", 1)[1] if names else f"{int(time.time() * 1000):013d}-{query}"


def write_changelog(changelog: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write rows carrying ``batch_id``; replaces exactly the batches present."""
    (
        changelog.select(F.lit(BATCH_RUN).alias(RUN), BATCH_ID, *TRAFFIC_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN, BATCH_ID)
        .format(fmt)
        .save(path)
    )


def batch_partition_path(path: str, batch_id: int, run: str = BATCH_RUN) -> str:
    """Folder of one micro-batch inside a change-log table."""
    return f"{path.rstrip('/')}/{RUN}={run}/{BATCH_ID}={int(batch_id)}"


def write_changelog_batch(batch: DataFrame, batch_id: int, path: str, fmt: str = "parquet", run: str = BATCH_RUN) -> None:
    """Idempotent write of one micro-batch of traffic rows: the batch owns
    the folder ``run=<run>/batch_id=<n>`` of the table and replaces it as a whole."""
    batch.select(*TRAFFIC_COLUMNS).write.mode("overwrite").format(fmt).save(
        batch_partition_path(path, batch_id, run)
    )


def append_changelog_batch(batch: DataFrame, batch_id: int, path: str, fmt: str = "parquet", run: str = BATCH_RUN) -> None:
    """Plain append (at-least-once: a re-run batch is stored twice)."""
    (
        batch.select(F.lit(run).alias(RUN), F.lit(batch_id).cast("long").alias(BATCH_ID), *TRAFFIC_COLUMNS)
        .write.mode("append")
        .partitionBy(RUN, BATCH_ID)
        .format(fmt)
        .save(path)
    )


def changelog_batch_writer(
    path: str, idempotent: bool = True, fmt: str = "parquet", count_rows: bool = False
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to the change log.

    Errors propagate and fail the query; the batch is then re-run on restart
    and, with ``idempotent``, overwrites its own partition. The number of
    rows written is in each progress report (``numRowsUpdated``); with
    ``count_rows`` it is also counted and logged here, and the batch is then
    persisted so the micro-batch plan still runs once (a second execution
    would double the state-store metrics).
    """
    write = write_changelog_batch if idempotent else append_changelog_batch

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, path)
        if not count_rows:
            write(batch, batch_id, path, fmt, run)
            return
        batch.persist()
        try:
            write(batch, batch_id, path, fmt, run)
            log.info("batch %s written: %s updated rows", batch_id, batch.count())
        finally:
            batch.unpersist()

    return sink


def read_changelog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The change log with ``run`` and ``batch_id`` from the folder names. Its
    schema is given, so no file is opened to find it."""
    return spark.read.format(fmt).schema(CHANGELOG).load(path)


def register_traffic_view(
    spark: SparkSession, changelog_path: str, name: str = "traffic_stats", fmt: str = "parquet"
) -> DataFrame:
    """Expose the current table over a stored change log as a temporary view
    with exactly the six traffic_stats columns (latest batch per key), for
    dashboards written in SQL."""
    current = latest_per_key(read_changelog(spark, changelog_path, fmt)).select(*TRAFFIC_COLUMNS)
    current.createOrReplaceTempView(name)
    return current


def compact_changelog(spark: SparkSession, changelog_path: str, out_path: str, fmt: str = "parquet") -> DataFrame:
    """Rewrite the change log as the current table (one row per key),
    partitioned by window date so dashboard reads prune by time."""
    current = latest_per_key(read_changelog(spark, changelog_path, fmt))
    (
        current.withColumn("window_date", F.to_date("window_start"))
        .hint("rebalance", "window_date")  # few files a date, a large date split
        .write.mode("overwrite")
        .partitionBy("window_date")
        .format(fmt)
        .save(out_path)
    )
    return spark.read.format(fmt).load(out_path)


def ensure_traffic_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str | None = None,
    provider: str = "parquet",
    partition_cols: tuple[str, ...] = ("store_id", "zone_id"),
    database_location: str | None = None,
) -> str:
    """CREATE DATABASE / TABLE IF NOT EXISTS for the 6-column traffic table.
    Run once at start-up, not per batch. ``provider`` may be a lake format
    (for example iceberg) when its connector is installed."""
    db_loc = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{db_loc}")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRAFFIC_STATS.fields)
    loc = f" LOCATION '{location}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    name = f"{database}.{table}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {provider}{parts}{loc}")
    return name


def append_to_table(rows: DataFrame, name: str) -> None:
    """Append traffic rows to a catalog table made by ``ensure_traffic_table``,
    few files per table partition. At least once: a batch that is written again
    is stored again (the change log is the idempotent sink)."""
    table = rows.sparkSession.table(name)
    spread = rows.hint("rebalance", *(c.name for c in rows.sparkSession.catalog.listColumns(name) if c.isPartition))
    spread.select(*table.columns).write.insertInto(name)


def bus_records(events: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Sensor events as bus records: key = topic bytes, value = JSON bytes."""
    return events.select(
        F.col(topic_col).alias("topic"),
        F.encode(F.col(topic_col), "UTF-8").alias("key"),
        F.encode(sensor_event_json(), "UTF-8").alias("value"),
    )


def forwarded_records(envelope: DataFrame) -> DataFrame:
    """What a forwarder publishes of an envelope table or stream: records whose
    value is valid UTF-8, bytes unchanged, keyed by their topic."""
    return forward_valid(envelope).select("topic", F.encode("topic", "UTF-8").alias("key"), "value")


def publish_to_kafka(
    records: DataFrame, bootstrap_servers: str, topic: str, options: dict[str, str] | None = None
) -> None:
    """Publish (key, value) records to one Kafka topic (needs the
    spark-sql-kafka connector). ``options`` go to the writer: producer settings
    with the prefix ``kafka.`` (``kafka.acks``, ``kafka.security.protocol``, ...)."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .options(**(options or {}))
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def write_bus_records(events: DataFrame, path: str, topic_col: str = "topic", fmt: str = "parquet") -> None:
    """Publish sensor events as bus records to files: the offline analogue
    of ``publish_to_kafka``."""
    bus_records(events, topic_col).write.mode("append").format(fmt).save(path)
