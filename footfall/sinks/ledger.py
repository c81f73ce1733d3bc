"""Exactly-once append to a table of files, by a commit ledger.

Each delivery of a micro-batch writes a folder of its own, ``data/attempt=<id>``,
which never changes again. It counts once the ledger holds an entry for its
(run, batch), and an entry is put only where there is none: of two deliveries
of a batch one wins, and a writer that dies between write and commit leaves a
folder that no reader sees. Readers join the ledger, so they see whole batches
only, also while others are written. ``expire_attempts`` deletes what lost.

An entry is written to a name of its own and renamed, which fails where the
target exists; that is atomic on HDFS and local disks. On an object store
without such a rename the file system has to offer conditional writes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.operators.changelog import BATCH_ID, RUN, latest_per_key
from footfall.schemas import TRAFFIC_STATS
from footfall.sinks.tables import TRAFFIC_COLUMNS, folders, make_folder, remove_folder, run_of

ATTEMPT = "attempt"
LEDGER = "run string, batch_id long, attempt string, committed_ms long, facts map<string, long>"
PLACES = ("store_id", "zone_id")


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole unless one of that name is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    fs = target.getFileSystem(conf)
    out = fs.create(temp, False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(temp), fs.makeQualified(target), plain)
    except Py4JJavaError as refused:
        fs.delete(temp, False)
        if "AlreadyExists" in refused.java_exception.getClass().getName():
            return False
        raise
    return True


class CommitLedger:
    """Which attempt of each (run, batch) counts, and facts about it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, run: str, batch_id: int) -> str:
        return f"{self.path}/ledger/{RUN}={run}/{int(batch_id):012d}.json"

    def committed(self, run: str, batch_id: int) -> bool:
        return bool(folders(self.spark, self._file(run, batch_id)))

    def commit(self, run: str, batch_id: int, attempt: str, facts: dict[str, int | None] | None = None) -> bool:
        """Make ``attempt`` the one that counts; False if another one already does."""
        entry = {BATCH_ID: int(batch_id), ATTEMPT: attempt, "committed_ms": int(time.time() * 1000), "facts": facts or {}}
        make_folder(self.spark, f"{self.path}/ledger/{RUN}={run}")
        return put_if_absent(self.spark, self._file(run, batch_id), json.dumps(entry))

    def entries(self) -> DataFrame:
        """One row per committed batch."""
        make_folder(self.spark, f"{self.path}/ledger")
        return self.spark.read.schema(LEDGER).json(f"{self.path}/ledger")

    def attempt_folder(self, attempt: str) -> str:
        return f"{self.path}/data/{ATTEMPT}={attempt}"

    def read(self, schema: StructType | str) -> DataFrame:
        """Rows of committed batches, with ``run`` and ``batch_id``."""
        make_folder(self.spark, f"{self.path}/data")
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data")
        return rows.join(self.entries().select(ATTEMPT, RUN, BATCH_ID), ATTEMPT).drop(ATTEMPT)


def append_once(
    batch: DataFrame,
    batch_id: int,
    path: str,
    run: str,
    partition_by: tuple[str, ...] = PLACES,
    before_commit: Callable[[int], None] | None = None,
) -> bool:
    """Append a micro-batch to the table at ``path`` unless it is there already;
    whether these rows are the ones that count. ``before_commit`` runs between
    write and commit."""
    ledger = CommitLedger(batch.sparkSession, path)
    if ledger.committed(run, batch_id):
        return False
    attempt = uuid.uuid4().hex
    spread = batch.hint("rebalance", *partition_by) if partition_by else batch
    writer = spread.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(ledger.attempt_folder(attempt))
    if before_commit:
        before_commit(batch_id)
    return ledger.commit(run, batch_id, attempt)


def once_table_writer(path: str, before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends each micro-batch of traffic rows exactly once."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, f"{path.rstrip('/')}/ledger")
        append_once(batch.select(*TRAFFIC_COLUMNS), batch_id, path, run, before_commit=before_commit)

    return sink


def read_once_table(spark: SparkSession, path: str, latest: bool = True) -> DataFrame:
    """Traffic rows of committed batches; with ``latest`` the current row per
    key, else all of them with ``run`` and ``batch_id`` (update mode writes a
    key once per batch that changes it)."""
    rows = CommitLedger(spark, path).read(StructType(list(TRAFFIC_STATS.fields)).add(ATTEMPT, "string"))
    rows = rows.select(RUN, BATCH_ID, *TRAFFIC_COLUMNS)
    return latest_per_key(rows).select(*TRAFFIC_COLUMNS) if latest else rows


def expire_attempts(spark: SparkSession, path: str, older_than_s: float = 86_400.0) -> list[str]:
    """Delete folders of attempts that lost or were never committed, if written
    longer ago than any writer may still be at work; returns them."""
    ledger = CommitLedger(spark, path)
    held = spark.createDataFrame([(p, p.rsplit("=", 1)[1]) for p in folders(spark, f"{ledger.path}/data/{ATTEMPT}=*")], "folder string, attempt string")
    fs = spark._jvm.org.apache.hadoop.fs.Path(ledger.path).getFileSystem(spark._jsc.hadoopConfiguration())
    until = (time.time() - older_than_s) * 1000
    gone = []
    for r in held.join(ledger.entries().select(ATTEMPT), ATTEMPT, "left_anti").collect():  # folders that count for nothing
        if fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(r.folder)).getModificationTime() <= until:
            remove_folder(spark, r.folder)
            gone.append(r.folder)
    return gone
