"""Composable ``DataFrame -> DataFrame`` operators, valid on bounded and
streaming inputs alike (except where a docstring says otherwise)."""

from footfall.operators.accounting import audit_intervals, merged_findings, offset_intervals, unbalanced
from footfall.operators.aggregate import aggregate_traffic, aggregate_traffic_exact
from footfall.operators.asof import asof_left_join
from footfall.operators.changelog import changelog_by_batch, latest_by_count, latest_per_key
from footfall.operators.enrich import (
    enrich_with_time_flags,
    join_dimensions,
    with_event_time,
    with_local_time_flags,
)
from footfall.operators.joins import one_row_per_key, salted_left_join
from footfall.operators.parse import (
    decode_envelope,
    forward_valid,
    parse_sensor_events,
    utf8_gate,
)
from footfall.operators.quality import (
    accepted_events,
    classify_events,
    clean_sensor_events,
    demographics,
    duplicate_ids,
    quality_profile,
    rejected_events,
    unknown_store_zones,
)
from footfall.operators.serving import live_visitors, store_performance, zone_share

__all__ = [
    "accepted_events",
    "aggregate_traffic",
    "aggregate_traffic_exact",
    "asof_left_join",
    "audit_intervals",
    "duplicate_ids",
    "merged_findings",
    "offset_intervals",
    "unbalanced",
    "changelog_by_batch",
    "classify_events",
    "clean_sensor_events",
    "decode_envelope",
    "demographics",
    "enrich_with_time_flags",
    "forward_valid",
    "join_dimensions",
    "latest_by_count",
    "one_row_per_key",
    "salted_left_join",
    "latest_per_key",
    "live_visitors",
    "parse_sensor_events",
    "quality_profile",
    "rejected_events",
    "store_performance",
    "unknown_store_zones",
    "utf8_gate",
    "with_event_time",
    "with_local_time_flags",
    "zone_share",
]
