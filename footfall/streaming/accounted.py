"""An intake that accounts for every record: accepted, rejected or late.

A stateless stream writes each micro-batch into an attempt folder partitioned
by verdict, with the offsets it read as intervals beside it, and commits both
with its counts and its watermark through the ledger (``sinks.ledger``). The
watermark of a batch is the largest event time of the committed batches before
it, minus the delay. A record whose window has ended by then is late: it is kept
with the reason and the watermark instead of vanishing in an aggregation's
state. A traffic query that reads the accepted part with the same delay drops
nothing more, as its watermark never passes this one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.functions.time import event_time_from_millis
from footfall.operators.accounting import BUS, offset_intervals
from footfall.operators.aggregate import DEFAULT_WINDOW
from footfall.operators.changelog import BATCH_ID, RUN
from footfall.operators.parse import decode_envelope
from footfall.operators.quality import REJECT_REASON, classify_events
from footfall.schemas import SENSOR_EVENT, SENSOR_EVENT_FIELDS
from footfall.sinks.ledger import ATTEMPT, CommitLedger
from footfall.sinks.tables import run_of
from footfall.streaming.traffic import DEFAULT_WATERMARK, PLACE, _placed

ACCEPTED, REJECTED, LATE = "accepted", "rejected", "late"
LATE_REASON = "behind_watermark"

ROWS = (
    StructType(list(SENSOR_EVENT.fields))
    .add("event_time", "timestamp")
    .add("topic", "string").add("partition", "integer").add("offset", "long").add("bus_time", "timestamp")
    .add(REJECT_REASON, "string").add("watermark", "timestamp").add("payload", "string")
    .add("verdict", "string").add(ATTEMPT, "string")
)
INTERVALS = "topic string, partition int, first_offset long, last_offset long, n_records long, attempt string"


def accounted_records(envelopes: DataFrame, max_future_skew_ms: int | None = None) -> DataFrame:
    """Every record of the bus, decoded and classified, with its place and event time."""
    classified = classify_events(decode_envelope(_placed(envelopes), carry=PLACE), max_future_skew_ms=max_future_skew_ms)
    return classified.withColumn("event_time", F.when(F.col(REJECT_REASON).isNull(), event_time_from_millis("timestamp"))).select(
        *SENSOR_EVENT_FIELDS, "event_time", *PLACE, REJECT_REASON, "payload"
    )


def with_verdict(records: DataFrame, watermark_us: int | None, window_us: int) -> DataFrame:
    """``verdict`` of each record under a watermark (microseconds; None before the
    first batch). A record is late when its window's end is not after it."""
    mark = F.lit(watermark_us).cast("long")
    at = F.unix_micros("event_time")
    late = F.coalesce(at - F.pmod(at, F.lit(window_us)) + window_us <= mark, F.lit(False))
    verdict = F.when(F.col(REJECT_REASON).isNotNull(), REJECTED).when(late, LATE).otherwise(ACCEPTED)
    judged = records.withColumn("verdict", verdict)
    is_late = F.col("verdict") == LATE
    return judged.withColumn(REJECT_REASON, F.when(is_late, F.lit(LATE_REASON)).otherwise(F.col(REJECT_REASON))).withColumn(
        "watermark", F.when(is_late, F.timestamp_micros(mark))
    )


def watermark_before(ledger: CommitLedger, run: str, batch_id: int, delay_us: int) -> int | None:
    """Watermark that a batch is judged by: from the committed batches before it."""
    seen = ledger.entries().filter((F.col(RUN) == run) & (F.col(BATCH_ID) < batch_id))
    newest = seen.agg(F.max(F.col("facts")["max_event_us"])).first()[0]
    return None if newest is None else newest - delay_us


def _microseconds(spark: SparkSession, interval: str) -> int:
    zero = "timestamp_micros(0)"
    return spark.sql(f"SELECT unix_micros({zero} + INTERVAL {interval})").first()[0]


def accounted_writer(
    path: str,
    watermark_delay: str = DEFAULT_WATERMARK,
    window_duration: str = DEFAULT_WINDOW,
    before_commit: Callable[[int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for ``accounted_records``; a batch that comes
    again after its commit is left alone."""

    sizes: list[int] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not sizes:
            sizes.extend(_microseconds(spark, i) for i in (watermark_delay, window_duration))
        ledger = CommitLedger(spark, path)
        run = run_of(batch, f"{ledger.path}/ledger")
        if ledger.committed(run, batch_id):
            return
        mark = watermark_before(ledger, run, batch_id, sizes[0])
        attempt = uuid.uuid4().hex
        with_verdict(batch, mark, sizes[1]).write.partitionBy("verdict").parquet(ledger.attempt_folder(attempt))
        rows = spark.read.schema(ROWS).parquet(ledger.attempt_folder(attempt))
        offset_intervals(rows, BUS).write.parquet(f"{ledger.path}/intervals/{ATTEMPT}={attempt}")
        counts = [F.count_if(F.col("verdict") == v).alias(v) for v in (ACCEPTED, REJECTED, LATE)]
        newest = F.unix_micros(F.max(F.when(F.col("verdict") == ACCEPTED, F.col("event_time")))).alias("max_event_us")
        facts = rows.agg(F.count(F.lit(1)).alias("read"), *counts, newest).first().asDict() | {"watermark_us": mark}
        if before_commit:
            before_commit(batch_id)
        ledger.commit(run, batch_id, attempt, {k: v for k, v in facts.items() if v is not None})

    return sink


def read_accounted(spark: SparkSession, path: str, verdict: str | None = None) -> DataFrame:
    """Records of committed batches with their verdict; of one verdict only, if
    given (the others' files are not read)."""
    rows = CommitLedger(spark, path).read(ROWS)
    return rows if verdict is None else rows.filter(F.col("verdict") == verdict)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Offset intervals of committed batches, with ``run`` and ``batch_id``."""
    ledger = CommitLedger(spark, path)
    held = spark.read.schema(INTERVALS).parquet(f"{ledger.path}/intervals")
    return held.join(ledger.entries().select(ATTEMPT, RUN, BATCH_ID), ATTEMPT).drop(ATTEMPT)


def batch_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Per committed batch: records read, accepted, rejected and late, and the
    watermark it was judged by."""
    facts = F.col("facts")
    counts = [F.coalesce(facts[c], F.lit(0).cast("long")).alias(c) for c in ("read", ACCEPTED, REJECTED, LATE)]
    return CommitLedger(spark, path).entries().select(RUN, BATCH_ID, *counts, F.timestamp_micros(facts["watermark_us"]).alias("watermark"))
