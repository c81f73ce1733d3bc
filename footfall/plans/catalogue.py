"""The query catalogue: one ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) in
full. Results pass through ``present`` so they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.fixed import TRIGGER_MS
from footfall.functions.payload import is_utf8
from footfall.operators.aggregate import aggregate_traffic
from footfall.operators.asof import asof_left_join
from footfall.operators.changelog import changelog_by_batch, latest_per_key
from footfall.operators.distribution import dwell_sketches, exact_ranks, merged_quantiles, target_fit, within_rank_error
from footfall.operators.enrich import (
    enrich_with_time_flags,
    join_dimensions,
    with_event_time,
    with_local_time_flags,
)
from footfall.operators.parse import decode_envelope
from footfall.operators.quality import (
    classify_events,
    clean_sensor_events,
    demographics,
    duplicate_ids,
    quality_profile,
    rejected_events,
    unknown_store_zones,
)
from footfall.operators.serving import live_visitors_from_events, store_performance, zone_share_from_events
from footfall.plans.output import present
from footfall.schemas import SENSOR_EVENT_FIELDS
from footfall.session import ensure_utc
from footfall.sources.bus import bus_envelope
from footfall.sources.dimensions import store_campaigns, stores_dimension, zones_dimension
from footfall.sources.events import sensor_events, sensor_events_with_offset
from footfall.sources.replay import replay_slice

TRAFFIC_ROUND = ("total_dwell_time",)


def clean_timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S -> noise filter -> event time."""
    return with_event_time(clean_sensor_events(sensor_events(spark, sf_dir)))


def traffic_changelog(spark: SparkSession, sf_dir: str, batch_ms: int = TRIGGER_MS) -> DataFrame:
    """The update-mode change log the streaming job writes when events arrive
    in real time and a micro-batch fires every ``batch_ms`` (one batch per
    epoch-aligned interval that has data)."""
    ev = clean_timed_events(spark, sf_dir).withColumn("batch_id", replay_slice("timestamp", batch_ms))
    return changelog_by_batch(ev)


def traffic_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current traffic table (one row per window, store and zone).

    It equals the latest change-log row per key (q10 and q17 check this),
    so the dashboards derive it with the single-shuffle window aggregate
    instead of rebuilding the change log."""
    return aggregate_traffic(clean_timed_events(spark, sf_dir))


def q01_utf8_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forwarder accounting per topic: records forwarded vs failed (invalid UTF-8)."""
    env = bus_envelope(spark, sf_dir, faults=True)
    ok = is_utf8("value")
    return env.groupBy("topic").agg(
        F.count_if(ok).alias("forwarded"), F.count_if(~ok).alias("failed")
    )


def q02_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope bytes -> UTF-8 text -> one JSON parse -> 8 sensor columns."""
    decoded = decode_envelope(bus_envelope(spark, sf_dir), carry=[])
    return decoded.select(*SENSOR_EVENT_FIELDS)


def q03_clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor events that pass the noise filter."""
    return clean_sensor_events(sensor_events(spark, sf_dir))


def q04_reject_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected bus record with the first failing check."""
    decoded = decode_envelope(bus_envelope(spark, sf_dir, faults=True), carry=["topic", "offset"])
    return rejected_events(classify_events(decoded)).select("offset", "topic", "reject_reason")


def q05_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time from epoch milliseconds for every event."""
    s = with_event_time(sensor_events(spark, sf_dir))
    return present(s.select("event_id", "timestamp", "event_time"))


def q06_enrich_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with UTC peak-hour and weekend flags."""
    return enrich_with_time_flags(clean_sensor_events(sensor_events(spark, sf_dir)))


def q07_traffic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: visitors and dwell per 5-minute window, store and zone."""
    return present(aggregate_traffic(clean_timed_events(spark, sf_dir)), TRAFFIC_ROUND)


def q08_traffic_window_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship aggregate with a 15-minute window."""
    return present(aggregate_traffic(clean_timed_events(spark, sf_dir), "15 minutes"), TRAFFIC_ROUND)


def q09_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode change log with the 5-second trigger (running totals)."""
    return present(traffic_changelog(spark, sf_dir), TRAFFIC_ROUND)


def q10_latest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per key of the 5-second change log."""
    return present(latest_per_key(traffic_changelog(spark, sf_dir)), TRAFFIC_ROUND)


def q11_live_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors over all stores in the newest 5-minute window."""
    return present(live_visitors_from_events(clean_timed_events(spark, sf_dir)))


def q12_store_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors and dwell per store over the current table."""
    return present(store_performance(traffic_current(spark, sf_dir)), TRAFFIC_ROUND)


def q13_zone_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each zone's share of all visitors over the current table."""
    return zone_share_from_events(clean_timed_events(spark, sf_dir))


def q14_dim_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with store and zone attributes (left joins)."""
    ev = clean_timed_events(spark, sf_dir).select("event_id", "store_id", "zone_id", "event_time")
    out = join_dimensions(ev, stores_dimension(spark, sf_dir), zones_dimension(spark, sf_dir))
    return present(
        out.select(
            "event_id", "store_id", "zone_id", "event_time",
            "store_name", "tz", "zone_name", "product_category",
        )
    )


def q15a_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their share per (age range, gender)."""
    return demographics(sensor_events(spark, sf_dir))


def q15b_reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(store, zone) pairs of events that have no zone-dimension row."""
    return unknown_store_zones(sensor_events(spark, sf_dir), zones_dimension(spark, sf_dir))


def q16_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row data-quality profile of the sensor events."""
    return quality_profile(sensor_events(spark, sf_dir))


def q21_local_time_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak-hour and weekend flags in each store's own time zone."""
    ev = clean_timed_events(spark, sf_dir).select("event_id", "store_id", "event_time")
    out = with_local_time_flags(ev, stores_dimension(spark, sf_dir))
    return present(
        out.select("event_id", "store_id", "tz", "local_time", "is_peak_hour_local", "is_weekend_local")
    )


def q36_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids that a bus delivering some records two or three times carries more than once."""
    s = sensor_events_with_offset(spark, sf_dir)
    again = s.filter(F.col("offset") % 50 == 0).unionByName(s.filter(F.col("offset") % 350 == 0))
    return duplicate_ids(s.unionByName(again))


def q39_odd_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with keys the schema does not know (dropped) and without an event
    id (rejected), on the bus: what each is parsed to."""
    decoded = decode_envelope(bus_envelope(spark, sf_dir, odd_fields=True), carry=["offset"])
    return classify_events(decoded).select("offset", "reject_reason", *SENSOR_EVENT_FIELDS)


def q40_asof_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with the version of their store's campaign that was valid at their time."""
    events = clean_timed_events(spark, sf_dir).select("event_id", "store_id", "event_time")
    return present(asof_left_join(events, store_campaigns(spark, sf_dir), ["store_id"]))


def q44_dwell_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dwell-time quantiles per store, merged from one sketch per store and day,
    and whether their exact ranks lie within the sketch's error bound."""
    events = clean_timed_events(spark, sf_dir).select("store_id", "event_time", "dwell_time_seconds")
    days = dwell_sketches(events.withColumn("day", F.to_date("event_time")), ["store_id", "day"])
    ranked = exact_ranks(events, merged_quantiles(days, ["store_id"]), "store_id")
    return ranked.select("store_id", "probability", "n_events", within_rank_error().alias("within_bound"))


def q45_target_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chi-square of the demographics against the shares their producer draws them with."""
    return target_fit(sensor_events(spark, sf_dir))


def _with_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name, each pinning the session to UTC first."""
    from footfall.plans import streamed

    fns = [
        q01_utf8_gate, q02_parse_json, q03_clean_events, q04_reject_events,
        q05_event_time, q06_enrich_flags, q07_traffic_stats, q08_traffic_window_15m,
        q09_changelog, q10_latest_stats, q11_live_visitors, q12_store_performance,
        q13_zone_share, q14_dim_enriched, q15a_demographics, q15b_reference_check,
        q16_quality_profile, *streamed.STREAMED, q21_local_time_flags, q36_duplicate_ids, q39_odd_fields,
        q40_asof_campaign, q44_dwell_quantiles, q45_target_fit,
    ]
    return {f.__name__: _with_utc(f) for f in sorted(fns, key=lambda f: f.__name__)}
