"""Oracle SQL (DuckDB dialect) for each catalogue query.

The views ``region nation customer supplier part orders lineitem events ...``
are registered by the caller. ``S`` restates the sensor-event mapping of
``footfall.sources.events`` and ``C`` the noise filter plus event time.
Timestamps are TIMESTAMP (UTC wall clock); floating sums are rounded to 4.
"""

from __future__ import annotations

# Sensor-event view over `events` (same rule as footfall.sources.events).
S = """
s AS (
  SELECT e.event_id AS src_id,
         e.ts AS bus_time,
         cast(e.event_id AS VARCHAR) AS event_id,
         epoch_us(e.ts) // 1000 AS "timestamp",
         CASE WHEN e.event_id % 97 = 0 THEN NULL
              ELSE 'STORE_0' || cast(e.user_id % 3 + 1 AS VARCHAR) END AS store_id,
         CASE WHEN e.event_id % 89 = 0 THEN NULL
              ELSE 'ZONE_' || substr('ABCD', cast(e.user_id // 3 AS INTEGER) % 4 + 1, 1) END AS zone_id,
         'SENSOR_' || cast(1000 + e.user_id AS VARCHAR) AS sensor_id,
         (['under_18', '18-25', '26-35', '36-50', 'over_50'])[e.user_id % 5 + 1] AS age_range,
         (['male', 'female', 'unknown'])[e.event_id % 3 + 1] AS gender,
         CASE WHEN e.event_type = 'error' THEN -e.value ELSE e.value * 10 END AS dwell_time_seconds
  FROM events e
)"""

S_COLS = "event_id, \"timestamp\", store_id, zone_id, sensor_id, age_range, gender, dwell_time_seconds"

C = """
c AS (
  SELECT *, make_timestamp("timestamp" * 1000) AS event_time
  FROM s
  WHERE dwell_time_seconds > 0 AND dwell_time_seconds <= 3600
    AND store_id IS NOT NULL AND zone_id IS NOT NULL AND event_id IS NOT NULL
)"""

STORES = """
stores AS (
  SELECT printf('STORE_%02d', r_regionkey + 1) AS store_id,
         r_name || ' store' AS store_name,
         CASE r_name WHEN 'AFRICA' THEN 'Africa/Johannesburg'
                     WHEN 'AMERICA' THEN 'America/New_York'
                     WHEN 'ASIA' THEN 'Asia/Tokyo'
                     WHEN 'EUROPE' THEN 'Europe/Zurich'
                     WHEN 'MIDDLE EAST' THEN 'Asia/Dubai'
                     ELSE 'UTC' END AS tz
  FROM region
)"""

ZONES = """
zones AS (
  SELECT 'ZONE_' || chr(cast(64 + row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER)) AS zone_id,
         printf('STORE_%02d', n_regionkey + 1) AS store_id,
         n_name AS zone_name,
         n_name AS product_category
  FROM nation
)"""


def traffic(window: str = "5 MINUTE", rounded: bool = True) -> str:
    """Window aggregate over ``c`` (clean events) in DuckDB SQL."""
    dwell = "round(sum(dwell_time_seconds), 4)" if rounded else "sum(dwell_time_seconds)"
    return f"""
SELECT time_bucket(INTERVAL {window}, event_time) AS window_start,
       time_bucket(INTERVAL {window}, event_time) + INTERVAL {window} AS window_end,
       store_id, zone_id,
       count(*) AS visitor_count,
       {dwell} AS total_dwell_time
FROM c
GROUP BY ALL"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


Q07 = _with(S, C) + traffic()

def changelog(batch: str, window: str = "5 MINUTE") -> str:
    """Update-mode change log of events that arrive in the batch an expression names."""
    return f"""
per AS (
  SELECT {batch} AS batch_id,
         time_bucket(INTERVAL {window}, event_time) AS window_start,
         store_id, zone_id,
         count(*) AS n, sum(dwell_time_seconds) AS dwell
  FROM c GROUP BY ALL
)"""


def running(window: str = "5 MINUTE") -> str:
    """Running totals per key over the batches of ``changelog``."""
    return f"""
SELECT batch_id, window_start, window_start + INTERVAL {window} AS window_end, store_id, zone_id,
       cast(sum(n) OVER w AS BIGINT) AS visitor_count,
       round(sum(dwell) OVER w, 4) AS total_dwell_time
FROM per
WINDOW w AS (PARTITION BY window_start, store_id, zone_id ORDER BY batch_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

# 5-second trigger batches (q09) and 5-day replay slices (q18).
Q09 = _with(S, C, changelog('"timestamp" // 5000')) + running()
Q18 = _with(S, C, changelog('"timestamp" // 432000000')) + running()
# Events scattered over four batches, totals by day (q29).
Q29 = _with(S, C, changelog("src_id % 4", "1 DAY")) + running("1 DAY")

CURRENT = "t AS (" + traffic(rounded=False) + ")"

Q11 = _with(S, C, CURRENT) + """
SELECT window_start, window_end,
       cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       count(*) AS active_zones
FROM t WHERE window_start = (SELECT max(window_start) FROM t)
GROUP BY ALL"""

Q12 = _with(S, C, CURRENT) + """
SELECT store_id,
       cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       round(sum(total_dwell_time), 4) AS total_dwell_time,
       count(*) AS active_windows
FROM t GROUP BY store_id"""

Q13 = _with(S, C, CURRENT) + """
SELECT store_id, zone_id,
       cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       cast(sum(visitor_count) AS BIGINT) / (SELECT cast(sum(visitor_count) AS BIGINT) FROM t) AS share
FROM t GROUP BY store_id, zone_id"""

Q01 = _with(S) + """
SELECT 'sensors/' || coalesce(store_id, 'unassigned') AS topic,
       count(*) FILTER (WHERE src_id % 101 <> 0) AS forwarded,
       count(*) FILTER (WHERE src_id % 101 = 0) AS failed
FROM s GROUP BY ALL"""

Q02 = _with(S) + f"\nSELECT {S_COLS} FROM s"

Q03 = _with(S, C) + f"\nSELECT {S_COLS} FROM c"

CLASSIFIED = """
  SELECT src_id AS "offset",
         'sensors/' || coalesce(store_id, 'unassigned') AS topic,
         CASE WHEN src_id % 101 = 0 THEN 'invalid_utf8'
              WHEN src_id % 103 = 0 THEN 'malformed_json'
              WHEN event_id IS NULL THEN 'missing_event_id'
              WHEN store_id IS NULL THEN 'missing_store_id'
              WHEN zone_id IS NULL THEN 'missing_zone_id'
              WHEN dwell_time_seconds IS NULL OR isnan(dwell_time_seconds) THEN 'invalid_dwell_time'
              WHEN dwell_time_seconds <= 0 THEN 'dwell_not_positive'
              WHEN dwell_time_seconds > 3600 THEN 'dwell_too_long'
         END AS reject_reason
  FROM s"""

Q04 = _with(S) + f"\nSELECT * FROM ({CLASSIFIED}) WHERE reject_reason IS NOT NULL"

Q30 = _with(S) + f"""
SELECT "offset", topic, reject_reason IS NOT NULL AS rejected, reject_reason FROM ({CLASSIFIED})"""

Q05 = _with(S) + """
SELECT event_id, "timestamp", make_timestamp("timestamp" * 1000) AS event_time FROM s"""

Q06 = _with(S, C) + f"""
SELECT {S_COLS},
       coalesce(hour(event_time) >= 9 AND hour(event_time) < 18, false) AS is_peak_hour,
       coalesce(dayofweek(event_time) IN (0, 6), false) AS is_weekend
FROM c"""

Q08 = _with(S, C) + traffic("15 MINUTE")

Q14 = _with(S, C, STORES, ZONES) + """
SELECT c.event_id, c.store_id, c.zone_id, c.event_time,
       st.store_name, st.tz, z.zone_name, z.product_category
FROM c
LEFT JOIN zones z ON z.store_id = c.store_id AND z.zone_id = c.zone_id
LEFT JOIN stores st ON st.store_id = c.store_id"""

Q15A = _with(S) + """
SELECT age_range, gender, count(*) AS n_events,
       count(*) / (SELECT count(*) FROM s) AS share
FROM s GROUP BY ALL"""

Q15B = _with(S, ZONES) + """,
pairs AS (SELECT store_id, zone_id, count(*) AS n_events FROM s GROUP BY ALL)
SELECT p.store_id, p.zone_id, p.n_events FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.store_id = p.store_id AND z.zone_id = p.zone_id)"""

_IN_DOMAIN = "(dwell_time_seconds BETWEEN 0 AND 3600 AND NOT isnan(dwell_time_seconds))"

Q16 = _with(S) + f"""
SELECT count(*) AS n_events,
       count(DISTINCT event_id) AS n_distinct_event_ids,
       count(event_id) - count(DISTINCT event_id) AS n_duplicate_event_ids,
       count(*) FILTER (WHERE event_id IS NULL) AS n_missing_event_id,
       count(*) FILTER (WHERE store_id IS NULL) AS n_missing_store_id,
       count(*) FILTER (WHERE zone_id IS NULL) AS n_missing_zone_id,
       count(*) FILTER (WHERE NOT coalesce(age_range IN ('under_18', '18-25', '26-35', '36-50', 'over_50'), false)) AS n_bad_age_range,
       count(*) FILTER (WHERE NOT coalesce(gender IN ('male', 'female', 'unknown'), false)) AS n_bad_gender,
       count(*) FILTER (WHERE NOT coalesce({_IN_DOMAIN}, false)) AS n_dwell_out_of_domain,
       round(avg(CASE WHEN {_IN_DOMAIN} THEN dwell_time_seconds END), 4) AS mean_dwell_seconds,
       count(*) FILTER (WHERE {_IN_DOMAIN} AND dwell_time_seconds < 30)
         / count(*) FILTER (WHERE {_IN_DOMAIN}) AS share_dwell_under_30s
FROM s"""

Q21 = _with(S, C, STORES) + """,
l AS (
  SELECT c.event_id, c.store_id, coalesce(st.tz, 'UTC') AS tz,
         timezone(coalesce(st.tz, 'UTC'), c.event_time AT TIME ZONE 'UTC') AS local_time
  FROM c LEFT JOIN stores st ON st.store_id = c.store_id
)
SELECT event_id, store_id, tz, local_time,
       coalesce(hour(local_time) >= 9 AND hour(local_time) < 18, false) AS is_peak_hour_local,
       coalesce(dayofweek(local_time) IN (0, 6), false) AS is_weekend_local
FROM l"""

# Late copies (half the dwell time) count only in windows that the final
# watermark leaves open.
Q20 = _with(S, C, """
l AS (
  SELECT *, make_timestamp("timestamp" * 1000) AS event_time
  FROM (SELECT * REPLACE (dwell_time_seconds / 2 AS dwell_time_seconds) FROM s)
  WHERE dwell_time_seconds > 0 AND dwell_time_seconds <= 3600
    AND store_id IS NOT NULL AND zone_id IS NOT NULL AND event_id IS NOT NULL
)""", """
a AS (
  SELECT * FROM c
  UNION ALL BY NAME
  SELECT * FROM l
  WHERE time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE > (SELECT max(event_time) FROM c) - INTERVAL 10 MINUTE
)""") + traffic().replace("FROM c", "FROM a")

# Closed windows under the final watermark: window end at or before the
# largest clean event time minus the 10-minute delay.
Q22 = _with(S, C) + ", agg AS (" + traffic() + """)
SELECT * FROM agg
WHERE window_end <= (SELECT max(event_time) FROM c) - INTERVAL 10 MINUTE"""


# The traffic of the records that the transport faults leave whole.
Q31 = _with(S, C) + traffic().replace("FROM c", "FROM c WHERE src_id % 101 <> 0 AND src_id % 103 <> 0")


# Offsets that never come (of every thousand 500 to 509, or missing from the
# table) and that come twice (200 to 204), as runs (q33).
Q33 = _with(S) + """,
d AS (SELECT src_id AS o, lag(src_id) OVER (ORDER BY src_id) AS p FROM s WHERE NOT src_id % 1000 BETWEEN 500 AND 509),
twice AS (SELECT src_id AS o, src_id - row_number() OVER (ORDER BY src_id) AS island FROM s WHERE src_id % 1000 BETWEEN 200 AND 204)
SELECT 'gap' AS kind, p + 1 AS first_offset, o - 1 AS last_offset FROM d WHERE o > p + 1
UNION ALL
SELECT 'overlap', min(o), max(o) FROM twice GROUP BY island"""

# A replay by 5-day slices in which every record comes again three slices later
# with half its dwell time; a batch's watermark is 10 minutes below the newest
# clean event of the slices before it.
LATE = """,
bus AS (
  SELECT *, "timestamp" // 432000000 AS slice, false AS copy FROM s
  UNION ALL BY NAME
  SELECT * REPLACE (dwell_time_seconds / 2 AS dwell_time_seconds), "timestamp" // 432000000 + 3 AS slice, true AS copy FROM s
),
judged AS (
  SELECT *, make_timestamp("timestamp" * 1000) AS event_time,
         {faulted}
         OR coalesce(NOT (dwell_time_seconds > 0 AND dwell_time_seconds <= 3600), true)
         OR store_id IS NULL OR zone_id IS NULL OR event_id IS NULL AS rejected
  FROM bus
),
newest AS (SELECT slice, max(event_time) FILTER (WHERE NOT rejected) AS newest FROM judged GROUP BY slice),
marks AS (
  SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS batch_id,
         max(newest) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS watermark
  FROM newest
),
v AS (
  SELECT *, NOT rejected AND coalesce(time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <= watermark, false) AS late
  FROM judged JOIN marks USING (slice)
)"""

Q34 = _with(S) + LATE.format(faulted="false") + """
SELECT src_id AS "offset", 'sensors/' || coalesce(store_id, 'unassigned') AS topic, dwell_time_seconds,
       'behind_watermark' AS reject_reason, watermark
FROM v WHERE late"""

Q35 = _with(S) + LATE.format(faulted="(NOT copy AND (src_id % 101 = 0 OR src_id % 103 = 0))") + """
SELECT batch_id, count(*) AS "read", count(*) FILTER (WHERE NOT rejected AND NOT late) AS accepted,
       count(*) FILTER (WHERE rejected) AS rejected, count(*) FILTER (WHERE late) AS late, watermark
FROM v GROUP BY batch_id, watermark"""

Q36 = _with(S) + """
SELECT event_id, 1 + cast(src_id % 50 = 0 AS BIGINT) + cast(src_id % 350 = 0 AS BIGINT) AS n_events
FROM s WHERE src_id % 50 = 0"""

# Windows that the watermark of the last batch leaves open, and those that the
# watermark after it does (q37).
Q37 = _with(S, C) + ", agg AS (" + traffic() + """),
last AS (SELECT max("timestamp" // 432000000) AS slice FROM s)
SELECT 'open' AS phase, * FROM agg
WHERE window_end > coalesce((SELECT max(event_time) FROM c, last WHERE "timestamp" // 432000000 < slice) - INTERVAL 10 MINUTE, TIMESTAMP '1970-01-01')
UNION ALL
SELECT 'evicted', * FROM agg WHERE window_end > (SELECT max(event_time) FROM c) - INTERVAL 10 MINUTE"""

# Sums of whole seconds and of 2^-32 parts, each exact (q38).
Q38 = _with(S, C, """
x AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, store_id, zone_id, count(*) AS visitor_count,
         cast(sum(cast(floor(dwell_time_seconds) AS BIGINT)) AS BIGINT) AS w,
         cast(sum(cast(floor((dwell_time_seconds - floor(dwell_time_seconds)) * 4294967296) AS BIGINT)) AS BIGINT) AS p
  FROM c GROUP BY ALL
)""") + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, store_id, zone_id, visitor_count,
       cast(w + p // 4294967296 AS DOUBLE) + cast(p % 4294967296 AS DOUBLE) / 4294967296 AS total_dwell_time
FROM x"""

Q39 = _with(S) + f"""
SELECT src_id AS "offset",
       CASE WHEN src_id % 109 = 0 THEN 'missing_event_id'
            WHEN store_id IS NULL THEN 'missing_store_id'
            WHEN zone_id IS NULL THEN 'missing_zone_id'
            WHEN dwell_time_seconds IS NULL OR isnan(dwell_time_seconds) THEN 'invalid_dwell_time'
            WHEN dwell_time_seconds <= 0 THEN 'dwell_not_positive'
            WHEN dwell_time_seconds > 3600 THEN 'dwell_too_long' END AS reject_reason,
       {S_COLS.replace('event_id', 'CASE WHEN src_id % 109 <> 0 THEN event_id END AS event_id', 1)}
FROM s"""


# The campaign of the event's store that started last, of those at or before it;
# of campaigns that start together, the one of the greatest customer key (q40, q41).
Q40 = _with(S, C, """
v AS (
  SELECT 'STORE_0' || cast(c_custkey % 3 + 1 AS VARCHAR) AS store_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(cast(c_custkey * 7919 % 720 AS INTEGER)) AS valid_from,
         max(cast(c_custkey AS BIGINT)) AS version, arg_max(c_mktsegment, c_custkey) AS campaign
  FROM customer GROUP BY ALL
)""") + """
SELECT c.event_id, c.store_id, c.event_time, v.valid_from, v.version, v.campaign
FROM c ASOF LEFT JOIN v ON c.store_id = v.store_id AND c.event_time >= v.valid_from"""

# Valid records of the bus, numbered per topic; legacy frames hold no fields (q42).
Q42 = _with(S, """
b AS (
  SELECT *, 'sensors/' || coalesce(store_id, 'unassigned') AS topic, src_id % 103 <> 0 AS json
  FROM s WHERE src_id % 101 <> 0
)""") + """
SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY src_id) AS seq, src_id AS "offset",
       CASE WHEN json THEN event_id END AS event_id, CASE WHEN json THEN sensor_id END AS sensor_id,
       CASE WHEN json THEN gender END AS gender
FROM b"""


# Dashboards over the day windows of the batches so far (q43).
Q43 = _with(S, C, """
n AS (SELECT unnest([0, 1, 2, 3]) AS batch_id),
t AS (
  SELECT batch_id, time_bucket(INTERVAL 1 DAY, event_time) AS window_start, store_id, zone_id,
         count(*) AS visitor_count, sum(dwell_time_seconds) AS dwell
  FROM c JOIN n ON src_id % 4 <= batch_id GROUP BY ALL
),
newest AS (SELECT batch_id, max(window_start) AS window_start FROM t GROUP BY batch_id),
per_zone AS (SELECT batch_id, store_id, zone_id, cast(sum(visitor_count) AS BIGINT) AS visitor_count FROM t GROUP BY ALL)
""") + """
SELECT batch_id, 'live' AS dashboard, window_start, cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       count(*) AS active_zones, NULL AS store_id, NULL AS zone_id, NULL AS total_dwell_time, NULL AS active_windows, NULL AS share
FROM t JOIN newest USING (batch_id, window_start) GROUP BY batch_id, window_start
UNION ALL BY NAME
SELECT batch_id, 'stores' AS dashboard, store_id, cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       round(sum(dwell), 4) AS total_dwell_time, count(*) AS active_windows
FROM t GROUP BY batch_id, store_id
UNION ALL BY NAME
SELECT batch_id, 'zones' AS dashboard, store_id, zone_id, visitor_count,
       visitor_count / sum(visitor_count) OVER (PARTITION BY batch_id) AS share
FROM per_zone"""


# A sketch's quantiles differ from run to run; that they keep the bound does not (q44).
Q44 = _with(S, C) + """
SELECT store_id, probability, n_events, true AS within_bound
FROM (SELECT store_id, count(*) AS n_events FROM c GROUP BY store_id),
     (SELECT unnest([0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99])::DOUBLE AS probability)"""

Q45 = _with(S, """
target(dimension, value, share) AS (VALUES
  ('age_range', 'under_18', 0.10::DOUBLE), ('age_range', '18-25', 0.20), ('age_range', '26-35', 0.25),
  ('age_range', '36-50', 0.30), ('age_range', 'over_50', 0.15),
  ('gender', 'male', 0.48), ('gender', 'female', 0.48), ('gender', 'unknown', 0.04)),
seen AS (
  SELECT 'age_range' AS dimension, age_range AS value FROM s UNION ALL SELECT 'gender', gender FROM s),
per AS (
  SELECT t.dimension, t.value, t.share, count(seen.value) AS o
  FROM target t LEFT JOIN seen USING (dimension, value) GROUP BY ALL),
n AS (SELECT dimension, sum(o) AS n FROM per GROUP BY dimension),
x AS (
  SELECT dimension, cast(n AS BIGINT) AS n_events, sum((o - n * share) * (o - n * share) / (n * share)) AS chi, cast(count(*) - 1 AS INTEGER) AS degrees
  FROM per JOIN n USING (dimension) GROUP BY dimension, n)""") + """
SELECT dimension, n_events, (SELECT count(*) FROM s) - n_events AS n_outside, round(chi, 4) AS chi_square, degrees,
       chi <= CASE degrees WHEN 4 THEN 18.467 ELSE 13.816 END AS fits
FROM x"""


Q47 = _with(S, C, CURRENT) + """
SELECT store_id, cast(sum(visitor_count) AS BIGINT) AS visitor_count,
       round(sum(total_dwell_time), 4) AS total_dwell_time, count(*) AS active_windows
FROM t WHERE store_id = 'STORE_01' AND window_start >= (SELECT max(window_start) FROM t) - INTERVAL 7 DAY
GROUP BY store_id"""


def oracle_queries() -> dict[str, str]:
    """DuckDB SQL for every catalogue query, by name."""
    return {
        "q01_utf8_gate": Q01,
        "q02_parse_json": Q02,
        "q03_clean_events": Q03,
        "q04_reject_events": Q04,
        "q05_event_time": Q05,
        "q06_enrich_flags": Q06,
        "q07_traffic_stats": Q07,
        "q08_traffic_window_15m": Q08,
        "q09_changelog": Q09,
        "q10_latest_stats": Q07,
        "q11_live_visitors": Q11,
        "q12_store_performance": Q12,
        "q13_zone_share": Q13,
        "q14_dim_enriched": Q14,
        "q15a_demographics": Q15A,
        "q15b_reference_check": Q15B,
        "q16_quality_profile": Q16,
        "q17_stream_traffic": Q07,
        "q18_idempotent_sink": Q18,
        "q19_bus_records": Q02,
        "q20_late_data": Q20,
        "q21_local_time_flags": Q21,
        "q22_closed_windows": Q22,
        "q23_table_append": Q07,
        "q24_folded_table": Q07,
        "q25_live_visitors_stored": Q11,
        "q26_store_performance_stored": Q12,
        "q27_zone_share_stored": Q13,
        "q28_dead_letters": Q04,
        "q29_stream_changelog": Q29,
        "q30_intake_table": Q30,
        "q31_intake_traffic": Q31,
        "q32_once_table": Q07,
        "q33_offset_audit": Q33,
        "q34_late_records": Q34,
        "q35_batch_accounts": Q35,
        "q36_duplicate_ids": Q36,
        "q37_state_rows": Q37,
        "q38_exact_traffic": Q38,
        "q39_odd_fields": Q39,
        "q40_asof_campaign": Q40,
        "q41_asof_stream": Q40,
        "q42_ordered_forwarder": Q42,
        "q43_live_dashboards": Q43,
        "q44_dwell_quantiles": Q44,
        "q45_target_fit": Q45,
        "q46_live_visitors_clustered": Q11,
        "q47_store_clustered": Q47,
    }
