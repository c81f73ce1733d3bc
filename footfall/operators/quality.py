"""Cleaning, reject classification and data-quality profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.time import valid_epoch_millis
from footfall.schemas import CORRUPT_COLUMN

from footfall.fixed import AGE_RANGES, GENDERS, MAX_DWELL_SECONDS, MIN_DWELL_SECONDS
from footfall.session import scratch_path

REJECT_REASON = "reject_reason"


def is_clean(min_dwell: float = MIN_DWELL_SECONDS, max_dwell: float = MAX_DWELL_SECONDS) -> Column:
    """The noise-filter predicate: dwell in (min, max], store, zone and event
    ids present. NULL or NaN dwell fails (NaN sorts above every number)."""
    d = F.col("dwell_time_seconds")
    return (
        (d > min_dwell)
        & (d <= max_dwell)
        & F.col("store_id").isNotNull()
        & F.col("zone_id").isNotNull()
        & F.col("event_id").isNotNull()
    )


def clean_sensor_events(
    df: DataFrame,
    min_dwell: float = MIN_DWELL_SECONDS,
    max_dwell: float = MAX_DWELL_SECONDS,
    require_event_time: bool = False,
) -> DataFrame:
    """Remove invalid / noisy events. Same columns, fewer rows.

    With ``require_event_time`` the epoch-millisecond ``timestamp`` must also
    convert to a timestamp; by default (as the original job) it is not
    checked here and a NULL time only disappears at windowing.
    """
    cond = F.coalesce(is_clean(min_dwell, max_dwell), F.lit(False))
    if require_event_time:
        cond = cond & valid_epoch_millis("timestamp")
    return df.filter(cond)


def reject_reason(
    min_dwell: float = MIN_DWELL_SECONDS,
    max_dwell: float = MAX_DWELL_SECONDS,
    has_gate: bool = True,
    max_future_skew_ms: int | None = None,
) -> Column:
    """First failing check of a decoded event, NULL when the event is accepted.

    Order: invalid_utf8, empty_payload, malformed_json, missing_event_id,
    missing_store_id, missing_zone_id, invalid_dwell_time (NULL/NaN),
    dwell_not_positive, dwell_too_long, bad_timestamp, and with
    ``max_future_skew_ms`` future_timestamp: event time more than that after
    the record's arrival on the bus (``bus_time``). Such an event would push
    the watermark ahead and make every later on-time event late.
    """
    d = F.col("dwell_time_seconds")
    branches: list[tuple[Column, str]] = []
    if has_gate:
        payload = F.col("payload")
        branches += [
            (~F.col("utf8_valid"), "invalid_utf8"),
            (payload.isNull() | (F.trim(payload) == ""), "empty_payload"),
            (F.col(CORRUPT_COLUMN).isNotNull(), "malformed_json"),
        ]
    branches += [
        (F.col("event_id").isNull(), "missing_event_id"),
        (F.col("store_id").isNull(), "missing_store_id"),
        (F.col("zone_id").isNull(), "missing_zone_id"),
        (d.isNull() | F.isnan(d), "invalid_dwell_time"),
        (d <= min_dwell, "dwell_not_positive"),
        (d > max_dwell, "dwell_too_long"),
        (~valid_epoch_millis("timestamp"), "bad_timestamp"),
    ]
    if max_future_skew_ms is not None:
        ahead = F.col("timestamp") > F.unix_millis(F.col("bus_time")) + F.lit(int(max_future_skew_ms))
        branches.append((ahead, "future_timestamp"))
    expr = None
    for cond, reason in branches:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def classify_events(decoded: DataFrame, has_gate: bool = True, **bounds) -> DataFrame:
    """Add ``reject_reason`` (NULL = accepted) to decoded events."""
    return decoded.withColumn(REJECT_REASON, reject_reason(has_gate=has_gate, **bounds))


def accepted_events(classified: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return classified.filter(F.col(REJECT_REASON).isNull())


def rejected_events(classified: DataFrame) -> DataFrame:
    """Rows with a reject reason."""
    return classified.filter(F.col(REJECT_REASON).isNotNull())


def quality_profile(events: DataFrame, exact_distinct: bool = True, rsd: float = 0.01) -> DataFrame:
    """One-row profile of a sensor-event table: volume, id uniqueness,
    dwell-time statistics and domain violations, in one distributed
    aggregation.

    The exact distinct count is an aggregate of its own over the id column, so
    its shuffle carries ids only; all other figures reduce to one row per task.
    Shares and means of a table without a valid dwell are NULL. With ``exact_distinct=False`` it is a
    HyperLogLog++ estimate (relative error ``rsd``) that shuffles only small
    sketches; every other figure stays exact."""
    d = F.col("dwell_time_seconds")
    in_domain = d.between(0.0, MAX_DWELL_SECONDS) & ~F.isnan(d)
    count_ids = F.count_distinct("event_id") if exact_distinct else F.approx_count_distinct("event_id", rsd)
    distinct = events.select(count_ids).scalar()
    plain = events.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("event_id").alias("_ids"),
        F.count_if(F.col("event_id").isNull()).alias("n_missing_event_id"),
        F.count_if(F.col("store_id").isNull()).alias("n_missing_store_id"),
        F.count_if(F.col("zone_id").isNull()).alias("n_missing_zone_id"),
        F.count_if(~F.coalesce(F.col("age_range").isin(*AGE_RANGES), F.lit(False))).alias(
            "n_bad_age_range"
        ),
        F.count_if(~F.coalesce(F.col("gender").isin(*GENDERS), F.lit(False))).alias(
            "n_bad_gender"
        ),
        F.count_if(~F.coalesce(in_domain, F.lit(False))).alias("n_dwell_out_of_domain"),
        F.round(F.avg(F.when(in_domain, d)), 4).alias("mean_dwell_seconds"),
        F.try_divide(F.count_if(in_domain & (d < 30.0)), F.count_if(in_domain)).alias("share_dwell_under_30s"),
    )
    counted = plain.withColumn("n_distinct_event_ids", distinct).withColumn("n_duplicate_event_ids", F.col("_ids") - F.col("n_distinct_event_ids"))
    first = ["n_events", "n_distinct_event_ids", "n_duplicate_event_ids"]
    return counted.select(*first, *[c for c in counted.columns if c not in first and c != "_ids"])


SUSPECTS = 2_000_000  # hashes of 8 bytes that are broadcast at most


def duplicate_ids(events: DataFrame, id_col: str = "event_id", suspects: int = SUSPECTS) -> DataFrame:
    """Ids that occur more than once, with ``n_events``; null ids take no part.

    First the ids' 64-bit hashes are counted (8 bytes move, not the ids). Only
    ids whose hash came twice, the duplicates and a few that collide, are then
    moved and counted exactly. Up to ``suspects`` such hashes are broadcast to
    the scan; beyond that they are joined, and Spark splits hot ones."""
    ids = events.select(F.col(id_col)).filter(F.col(id_col).isNotNull()).withColumn("_hash", F.xxhash64(id_col))
    twice = ids.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    path = scratch_path(events.sparkSession, "suspect_ids")
    twice.write.parquet(path)
    twice = events.sparkSession.read.schema(twice.schema).parquet(path)
    few = twice.limit(suspects + 1).count() <= suspects
    kept = ids.join(F.broadcast(twice) if few else twice, "_hash", "left_semi")
    return kept.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_events")).filter("n_events > 1")


def demographics(events: DataFrame) -> DataFrame:
    """Events per (age_range, gender) and their share of all events."""
    counts = events.groupBy("age_range", "gender").agg(F.count(F.lit(1)).alias("n_events"))
    total = counts.select(F.sum("n_events")).scalar()  # reuses the grouping's shuffle
    return counts.select("age_range", "gender", "n_events", (F.col("n_events") / total).alias("share"))


def unknown_store_zones(events: DataFrame, zones: DataFrame) -> DataFrame:
    """(store_id, zone_id) pairs seen in events with no zone-dimension row
    (a NULL id never matches), with their event counts. Events are reduced
    to one row per pair before the anti join."""
    pairs = events.groupBy("store_id", "zone_id").agg(F.count(F.lit(1)).alias("n_events"))
    return pairs.join(zones.select("store_id", "zone_id"), on=["store_id", "zone_id"], how="left_anti")
