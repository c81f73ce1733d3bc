"""Structured Streaming: the traffic query, dead letters and the run API."""

from footfall.streaming.accounted import (
    accounted_records,
    accounted_writer,
    batch_accounts,
    read_accounted,
    read_intervals,
)
from footfall.streaming.job import TrafficJobConfig, await_job, start_traffic_job
from footfall.streaming.traffic import (
    StreamResult,
    accepted_event_stream,
    dead_letter_stream,
    intake_events,
    intake_stream,
    read_rejected,
    run_query,
    state_rows,
    traffic_stream,
)

__all__ = [
    "StreamResult",
    "TrafficJobConfig",
    "await_job",
    "start_traffic_job",
    "accepted_event_stream",
    "dead_letter_stream",
    "intake_events",
    "intake_stream",
    "read_rejected",
    "accounted_records",
    "accounted_writer",
    "batch_accounts",
    "read_accounted",
    "read_intervals",
    "run_query",
    "state_rows",
    "traffic_stream",
]
