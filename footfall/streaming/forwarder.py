"""The forwarder as a running stream: records go on in the order of their key.

Each topic's records are numbered without gaps in the order of their offsets.
A batch writes its records and the head of every topic (last offset, last
number) to folders of its own and counts once the commit ledger names them. A
record at or below its topic's head has been forwarded already and is skipped,
so a writer that is lost, a batch that is run again and a bus that delivers a
record twice leave the same table.

Offsets of a topic have to reach the batches in order, as they do on a bus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.operators.changelog import BATCH_ID, RUN
from footfall.operators.parse import forward_valid
from footfall.sinks.ledger import ATTEMPT, CommitLedger
from footfall.sinks.tables import run_of

BLOCK = 100_000  # offsets that one task numbers
SEQ = "seq"
HEADS = "topic string, last_offset long, last_seq long"
FORWARDED = "topic string, seq long, offset long, key binary, value binary, attempt string"


def numbered(records: DataFrame, heads: DataFrame, block: int = BLOCK) -> DataFrame:
    """Records beyond their topic's head, once each, with ``seq``.

    Blocks of offsets are counted first; running sums over a topic's blocks
    give the number each starts from, so a topic of any size is numbered by
    many tasks. Of records with equal topic and offset one stays."""
    fresh = records.join(heads, "topic", "left").filter(F.col("offset") > F.coalesce("last_offset", F.lit(-1)))
    fresh = fresh.dropDuplicates(["topic", "offset"]).withColumn("_block", F.floor(F.col("offset") / block))
    sizes = fresh.groupBy("topic", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("topic").orderBy("_block")) - F.col("_n")
    starts = sizes.select("topic", "_block", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("topic", "_block").orderBy("offset"))
    seq = F.coalesce("last_seq", F.lit(0)) + F.col("_before") + within
    return fresh.join(starts, ["topic", "_block"]).withColumn(SEQ, seq).drop("_block", "_before", "last_offset", "last_seq")


def forwarder_writer(
    path: str, before_commit: Callable[[int], None] | None = None, block: int = BLOCK
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that forwards a micro-batch of envelopes: those
    whose value is valid UTF-8, bytes unchanged, keyed by their topic, in files
    that hold ranges of (topic, seq). ``before_commit`` runs between write and
    commit."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(batch, f"{path.rstrip('/')}/ledger")
        ledger = CommitLedger(spark, path)
        if ledger.committed(run, batch_id):
            return
        attempt = uuid.uuid4().hex
        heads = _heads(spark, ledger, run)
        records = forward_valid(batch).select("topic", "offset", F.encode("topic", "UTF-8").alias("key"), "value")
        records.persist()  # counted and numbered
        try:
            ordered = numbered(records, heads, block).repartitionByRange("topic", SEQ).sortWithinPartitions("topic", SEQ)
            ordered.write.mode("errorifexists").parquet(ledger.attempt_folder(attempt))
        finally:
            records.unpersist()
        written = spark.read.schema(FORWARDED).parquet(ledger.attempt_folder(attempt))
        newest = heads.unionByName(written.select("topic", F.col("offset").alias("last_offset"), F.col(SEQ).alias("last_seq")))
        newest = newest.groupBy("topic").agg(F.max("last_offset").alias("last_offset"), F.max("last_seq").alias("last_seq"))
        newest.write.mode("errorifexists").parquet(_heads_folder(ledger, attempt))
        if before_commit:
            before_commit(batch_id)
        ledger.commit(run, batch_id, attempt)

    return sink


def _heads_folder(ledger: CommitLedger, attempt: str) -> str:
    return f"{ledger.path}/heads/{ATTEMPT}={attempt}"


def _heads(spark: SparkSession, ledger: CommitLedger, run: str) -> DataFrame:
    """Heads of all topics after the last committed batch of a run."""
    last = ledger.entries().filter(F.col(RUN) == run).agg(F.max_by(ATTEMPT, BATCH_ID)).first()[0]
    if last is None:
        return spark.createDataFrame([], HEADS)
    return spark.read.schema(HEADS).parquet(_heads_folder(ledger, last))


def read_forwarded(spark: SparkSession, path: str) -> DataFrame:
    """What has been forwarded: topic, seq, offset, key and value."""
    return CommitLedger(spark, path).read(FORWARDED).select("topic", SEQ, "offset", "key", "value")


def in_publish_order(records: DataFrame) -> DataFrame:
    """Records laid out so that one task writes a topic, in the order of ``seq``
    (a sort that spills, not a group held in memory): what a bus needs to keep
    the order within a key. A busy topic is then one writer's work."""
    return records.repartition("topic").sortWithinPartitions("topic", SEQ)
