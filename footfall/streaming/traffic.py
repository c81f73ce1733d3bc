"""The streaming traffic query.

envelopes -> UTF-8 gate + single JSON parse -> reject classification ->
accepted events -> event time + watermark -> 5-minute window aggregate ->
``foreachBatch`` sink. The same operators run on bounded DataFrames.

The watermark is declared after rejection, so an invalid event never moves
it; a valid event far in the future still does (it makes later events
late). Lateness is judged on window end: a window is dropped once its end
is at or before the watermark of the previous batch.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from footfall.fixed import TRIGGER_INTERVAL, WATERMARK_DELAY
from footfall.operators.aggregate import DEFAULT_WINDOW, aggregate_traffic
from footfall.operators.enrich import with_event_time
from footfall.operators.parse import decode_envelope
from footfall.operators.quality import REJECT_REASON, accepted_events, classify_events, rejected_events
from footfall.schemas import CORRUPT_COLUMN, INTAKE, SENSOR_EVENT_FIELDS
from footfall.sinks.tables import make_folder

log = logging.getLogger(__name__)

_START_LOCK = threading.Lock()

DEFAULT_WATERMARK = WATERMARK_DELAY
DEFAULT_TRIGGER = TRIGGER_INTERVAL

# State kept off-heap in RocksDB; each batch commits a change log of the
# state instead of a full snapshot. Applied to queries started here (new
# checkpoints keep the provider they were created with).
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _observed_intake(decoded: DataFrame) -> DataFrame:
    """Attach per-batch intake counters (records, invalid UTF-8) to the
    stream; they appear in each progress report under ``observedMetrics``."""
    return decoded.observe(
        "intake",
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.col("utf8_valid")).alias("invalid_utf8"),
    )


def accepted_event_stream(
    envelopes: DataFrame,
    watermark_delay: str | None = DEFAULT_WATERMARK,
    dedup: bool = False,
    max_future_skew_ms: int | None = None,
) -> DataFrame:
    """Accepted sensor events with ``event_time`` and a watermark.

    ``max_future_skew_ms`` rejects events stamped further than that ahead of
    their arrival time, so one bad sensor clock cannot advance the watermark.
    """
    carry = ["bus_time"] if max_future_skew_ms is not None else []
    decoded = _observed_intake(decode_envelope(envelopes, carry=carry))
    classified = classify_events(decoded, max_future_skew_ms=max_future_skew_ms)
    return _watermarked(accepted_events(classified).select(*SENSOR_EVENT_FIELDS), watermark_delay, dedup)


def _watermarked(events: DataFrame, watermark_delay: str | None, dedup: bool) -> DataFrame:
    ev = with_event_time(events)
    if watermark_delay:
        ev = ev.withWatermark("event_time", watermark_delay)
        if dedup:
            ev = ev.dropDuplicatesWithinWatermark(["event_id"])
    return ev


def traffic_stream(
    envelopes: DataFrame,
    watermark_delay: str = DEFAULT_WATERMARK,
    window_duration: str = DEFAULT_WINDOW,
    dedup: bool = False,
    max_future_skew_ms: int | None = None,
) -> DataFrame:
    """Windowed traffic over an envelope stream (or a bounded envelope table)."""
    events = accepted_event_stream(envelopes, watermark_delay, dedup, max_future_skew_ms)
    return aggregate_traffic(events, window_duration)


PLACE = ["topic", "partition", "offset", "bus_time"]


def _placed(envelopes: DataFrame) -> DataFrame:
    if "partition" in envelopes.columns:
        return envelopes
    return envelopes.withColumn("partition", F.lit(None).cast("int"))


def intake_stream(envelopes: DataFrame, max_future_skew_ms: int | None = None) -> DataFrame:
    """Every record of the bus, parsed once, as rows of the intake table:
    accepted ones with their event fields, rejected ones with reason, raw
    payload and no event fields. Written by ``run_query`` into a folder
    partitioned by ``rejected``, accepted and rejected records add up to all."""
    decoded = _observed_intake(decode_envelope(_placed(envelopes), carry=PLACE))
    classified = classify_events(decoded, max_future_skew_ms=max_future_skew_ms)
    rejected = F.col(REJECT_REASON).isNotNull()
    return classified.select(
        *[F.when(~rejected, F.col(c)).alias(c) for c in SENSOR_EVENT_FIELDS],
        *PLACE,
        REJECT_REASON,
        F.when(rejected, F.col("payload")).alias("payload"),
        F.col(CORRUPT_COLUMN).isNotNull().alias("unparsed"),
        rejected.alias("rejected"),
    )


def intake_events(
    spark: SparkSession,
    path: str,
    watermark_delay: str | None = DEFAULT_WATERMARK,
    dedup: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Accepted events of an intake table as a stream with ``event_time`` and a
    watermark. Only files that the file sink's log has committed are read, so a
    batch that had to be written again counts once. Rejects are not read, though
    their files count towards ``max_files_per_trigger``."""
    make_folder(spark, path)  # the reader may start before the first batch is there
    reader = spark.readStream.schema(INTAKE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    accepted = reader.parquet(path).filter(~F.col("rejected"))
    return _watermarked(accepted.select(*SENSOR_EVENT_FIELDS), watermark_delay, dedup)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected records of an intake table; accepted ones are not read."""
    return spark.read.schema(INTAKE).parquet(path).filter("rejected").select(
        *PLACE, REJECT_REASON, "payload", "unparsed"
    )


def dead_letter_stream(envelopes: DataFrame, max_future_skew_ms: int | None = None) -> DataFrame:
    """Rejected records with their reason, raw payload and bus position
    (``partition`` is null where the envelope has none). Takes the same bounds
    as the traffic query, so accepted and rejected records add up to all."""
    decoded = decode_envelope(_placed(envelopes), carry=PLACE)
    rejected = rejected_events(classify_events(decoded, max_future_skew_ms=max_future_skew_ms))
    return rejected.select(
        "topic",
        "partition",
        "offset",
        "bus_time",
        "reject_reason",
        "payload",
        F.col(CORRUPT_COLUMN).isNotNull().alias("unparsed"),
    )


@dataclass
class StreamResult:
    """Outcome of a finished run: batches and summed progress metrics.

    ``dropped_by_watermark`` is Spark's count of rows the state operator
    rejected as late; it sees rows after the map-side partial aggregate, so
    late events of one key within one task count once."""

    batches: int = 0
    input_rows: int = 0
    dropped_by_watermark: int = 0
    state_rows: int = 0
    observed: dict = field(default_factory=dict)
    watermarks: list = field(default_factory=list)  # reported per batch (ISO, UTC)


def _add(res: StreamResult, p: StreamingQueryProgress) -> None:
    res.batches += 1
    res.input_rows += int(p.numInputRows or 0)
    res.watermarks.append((p.eventTime or {}).get("watermark"))
    for op in p.stateOperators or []:
        res.dropped_by_watermark += int(op.numRowsDroppedByWatermark or 0)
        res.state_rows = int(op.numRowsTotal or 0)
    for name, row in (p.observedMetrics or {}).items():
        acc = res.observed.setdefault(name, {})
        for k, v in row.asDict().items():
            acc[k] = acc.get(k, 0) + (v or 0)


class _Totals(StreamingQueryListener):
    """Adds up every progress report of each run; a query itself keeps only the last hundred."""

    def __init__(self) -> None:
        self.results: dict[str, StreamResult] = {}
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.change:
            _add(self.results.setdefault(str(event.progress.runId), StreamResult()), event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def of(self, run_id: str, timeout_s: float = 60.0) -> StreamResult:
        """Totals of a run that has ended; its last reports may still be on their way."""
        with self.change:
            if not self.change.wait_for(lambda: run_id in self.ended, timeout_s):
                raise RuntimeError("the reports of the stream did not arrive")
            return self.results.get(run_id, StreamResult())


def run_query(
    spark: SparkSession,
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None] | str,
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    trigger_interval: str = DEFAULT_TRIGGER,
    state_partitions: int | None = None,
    query_name: str | None = None,
    rocksdb_state: bool = True,
    partition_by: str | None = None,
    evict_at_end: bool = False,
) -> StreamResult | StreamingQuery:
    """Start ``stream`` into ``sink``: a ``foreachBatch`` function, or a folder
    for Spark's built-in parquet file sink (append mode only; exactly-once
    through the sink's own metadata log, no Python call per micro-batch),
    partitioned by the column ``partition_by`` if given.

    With ``available_now`` (replays, back-fills, tests) this processes
    everything available, honouring the source's rate limit, blocks, and
    returns a summary; a failure raises. Otherwise it starts a
    processing-time trigger and returns the running query.
    ``state_partitions`` fixes the number of state-store partitions for a
    new checkpoint (it cannot change afterwards). ``evict_at_end`` lets an
    update-mode run end with the batch that only evicts closed windows.
    """
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if isinstance(sink, str):
        if output_mode != "append":
            raise ValueError("the file sink takes append mode only")
        writer = writer.format("parquet").option("path", sink)
        if partition_by:
            writer = writer.partitionBy(partition_by)
    else:
        writer = writer.foreachBatch(sink)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=trigger_interval
    )
    overrides = dict(ROCKSDB_STATE) if rocksdb_state else {}
    if state_partitions:
        overrides["spark.sql.shuffle.partitions"] = str(state_partitions)
    if available_now and output_mode == "update" and not evict_at_end:
        # The closing no-data batch would only evict state (update mode emits
        # nothing for it) just before the run ends. Append mode needs it: it
        # emits the windows the final watermark closes.
        overrides["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    totals = _Totals()
    if available_now:
        spark.streams.addListener(totals)
    with _START_LOCK:  # settings are swapped on the shared session around start()
        previous = {k: spark.conf.get(k, None) for k in overrides}
        for k, v in overrides.items():
            spark.conf.set(k, v)
        try:
            query = writer.start()  # the query keeps a copy of the session settings
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
    if not available_now:
        return query
    try:
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"stream failed: {query.exception()}")
        res = totals.of(str(query.runId))
    finally:
        spark.streams.removeListener(totals)
    log.info("stream finished: %s", res)
    return res


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """What the traffic aggregation of a checkpoint holds after a batch (the last
    one, if not given): one row per open window, store and zone, from Spark's
    state data source. Older batches can be read as long as their files are kept."""
    reader = spark.read.format("statestore")
    held = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
    key, value = F.col("key"), F.col("value")
    return held.select(
        key["window"]["start"].alias("window_start"), key["window"]["end"].alias("window_end"),
        key["store_id"].alias("store_id"), key["zone_id"].alias("zone_id"),
        value["count"].alias("visitor_count"), value["sum"].alias("total_dwell_time"),
    )
