"""The long-running traffic job: one envelope source, one or two streaming queries.

* traffic: accepted events -> watermark -> windowed aggregate -> change log
  (idempotent per micro-batch), ``update`` or ``append`` output mode;
* dead letters: rejected records with reason and raw payload;
* the exactly-once table and the accounted intake, where their paths are given.

With ``intake_path`` the bus is read and parsed once: one stateless query
writes accepted and rejected records to the intake table, and the traffic
query streams from its accepted part.

Each query has its own checkpoint under ``checkpoint_root``. Any failure
stops the other query and is raised, so a supervisor can restart the job;
restarted queries resume from their checkpoints.
"""

from __future__ import annotations

import os
import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.aggregate import DEFAULT_WINDOW, aggregate_traffic
from footfall.sinks.ledger import once_table_writer
from footfall.sinks.tables import batch_partition_path, changelog_batch_writer, run_of
from footfall.streaming.accounted import accounted_records, accounted_writer
from footfall.streaming.traffic import (
    DEFAULT_TRIGGER,
    DEFAULT_WATERMARK,
    dead_letter_stream,
    intake_events,
    intake_stream,
    run_query,
    traffic_stream,
)


_INTERVAL = re.compile(r"^\s*\d+\s+(millisecond|second|minute|hour|day)s?\s*$", re.IGNORECASE)


@dataclass
class TrafficJobConfig:
    changelog_path: str
    checkpoint_root: str
    dead_letter_path: str | None = None
    intake_path: str | None = None  # instead of dead_letter_path: one table of accepted and rejected records
    table_path: str | None = None  # besides the change log: a table appended exactly once (sinks.ledger)
    accounted_path: str | None = None  # every record as accepted, rejected or late, with counts and offsets per batch
    intake_files_per_trigger: int | None = None  # of the traffic query that reads the intake table
    watermark_delay: str = DEFAULT_WATERMARK
    window_duration: str = DEFAULT_WINDOW
    trigger_interval: str = DEFAULT_TRIGGER
    output_mode: str = "update"  # or "append": closed windows only
    idempotent: bool = True
    dedup: bool = False
    max_future_skew_ms: int | None = None
    state_partitions: int | None = None
    available_now: bool = False  # back-fill / replay: stop when caught up

    def __post_init__(self) -> None:
        if self.output_mode not in ("update", "append"):
            raise ValueError(f"output_mode must be 'update' or 'append', not {self.output_mode!r}")
        for name in ("watermark_delay", "window_duration", "trigger_interval"):
            value = getattr(self, name)
            if not isinstance(value, str) or not _INTERVAL.match(value):
                raise ValueError(f"{name} must look like '10 minutes', not {value!r}")
        if self.intake_path and self.dead_letter_path:
            raise ValueError("the intake table holds the rejects: give intake_path or dead_letter_path")
        for name in ("state_partitions", "max_future_skew_ms", "intake_files_per_trigger"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")
        if not self.changelog_path or not self.checkpoint_root:
            raise ValueError("changelog_path and checkpoint_root are required")


def traffic_writer(cfg: TrafficJobConfig):
    """``foreachBatch`` sink of the traffic query: the change log, and the
    exactly-once table if there is one, from one run of the batch."""
    log_batch = changelog_batch_writer(cfg.changelog_path, idempotent=cfg.idempotent)
    if not cfg.table_path:
        return log_batch
    append = once_table_writer(cfg.table_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            log_batch(batch, batch_id)
            append(batch, batch_id)
        finally:
            batch.unpersist()

    return sink


def dead_letter_writer(path: str):
    """``foreachBatch`` sink for rejects; each batch of a run owns its folder."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            batch_partition_path(path, batch_id, run_of(batch, path))
        )

    return sink


def start_traffic_job(spark: SparkSession, envelopes: DataFrame, cfg: TrafficJobConfig) -> list:
    """Start the traffic query (and the intake or dead-letter query when configured).

    Returns running queries, or run summaries when ``cfg.available_now``.
    """
    common = dict(
        available_now=cfg.available_now,
        trigger_interval=cfg.trigger_interval,
        state_partitions=cfg.state_partitions,
    )
    started = []
    if cfg.intake_path:
        started.append(
            run_query(
                spark,
                intake_stream(envelopes, cfg.max_future_skew_ms),
                cfg.intake_path,
                os.path.join(cfg.checkpoint_root, "intake"),
                output_mode="append",
                partition_by="rejected",
                **common,
            )
        )
        accepted = intake_events(spark, cfg.intake_path, cfg.watermark_delay, cfg.dedup, cfg.intake_files_per_trigger)
        traffic = aggregate_traffic(accepted, cfg.window_duration)
    else:
        traffic = traffic_stream(
            envelopes, cfg.watermark_delay, cfg.window_duration, cfg.dedup, cfg.max_future_skew_ms
        )
    started.append(
        run_query(
            spark,
            traffic,
            traffic_writer(cfg),
            os.path.join(cfg.checkpoint_root, "traffic"),
            output_mode=cfg.output_mode,
            query_name=None,
            **common,
        )
    )
    if cfg.dead_letter_path:
        started.append(
            run_query(
                spark,
                dead_letter_stream(envelopes, cfg.max_future_skew_ms),
                dead_letter_writer(cfg.dead_letter_path),
                os.path.join(cfg.checkpoint_root, "dead_letters"),
                output_mode="append",
                **common,
            )
        )
    if cfg.accounted_path:
        started.append(
            run_query(
                spark,
                accounted_records(envelopes, cfg.max_future_skew_ms),
                accounted_writer(cfg.accounted_path, cfg.watermark_delay, cfg.window_duration),
                os.path.join(cfg.checkpoint_root, "accounted"),
                output_mode="append",
                **common,
            )
        )
    return started


def await_job(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Block until one of the job's own queries ends (or the time is over, which
    leaves them running); then stop the others, and raise if one failed."""
    until = None if timeout_s is None else time.monotonic() + timeout_s
    while all(q.isActive for q in queries):
        if until is not None and time.monotonic() >= until:
            return
        time.sleep(0.2)
    failed = [q for q in queries if q.exception() is not None]
    for q in queries:
        if q.isActive:
            q.stop()
    if failed:
        raise RuntimeError(f"traffic job failed: {failed[0].exception()}")
