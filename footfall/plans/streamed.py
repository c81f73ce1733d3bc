"""Catalogue entries that run Structured Streaming queries or table sinks.

Each one replays the driver's events through a message-bus file replay (one
micro-batch per time slice) or writes a table, under a fresh folder inside
the shared checkpoint folder, then returns a DataFrame over what was written.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.operators.accounting import audit_intervals, merged_findings
from footfall.operators.aggregate import aggregate_traffic, aggregate_traffic_exact
from footfall.operators.changelog import BATCH_ID, RUN, changelog_by_batch, latest_per_key
from footfall.operators.parse import decode_envelope
from footfall.operators.serving import live_visitors, store_performance, zone_share
from footfall.plans.output import present
from footfall.schemas import ENVELOPE, INTAKE, SENSOR_EVENT_FIELDS, TRAFFIC_STATS
from footfall.session import scratch_path
from footfall.sinks.clustered import ROWS_PER_FILE, newest_window, read_clustered, write_clustered
from footfall.sinks.current import fold_changelog, read_current, read_newest_date
from footfall.sinks.ledger import append_once, once_table_writer, read_once_table
from footfall.sinks.tables import (
    append_to_table,
    changelog_batch_writer,
    ensure_traffic_table,
    read_changelog,
    write_bus_records,
    write_changelog,
)
from footfall.sources.bus import bus_envelope, topic_for_store
from footfall.sources.dimensions import store_campaigns
from footfall.sources.events import sensor_events
from footfall.sources.replay import (
    DEFAULT_SLICE_MS,
    envelope_file_stream,
    replay_slice,
    replay_steps,
    write_replay_files,
)
from footfall.streaming.accounted import (
    LATE,
    accounted_records,
    accounted_writer,
    batch_accounts,
    read_accounted,
    read_intervals,
)
from footfall.streaming.dashboards import (
    changelog_stream,
    live_visitors_now,
    place_totals,
    places_writer,
    read_places,
    store_performance_now,
    zone_share_now,
)
from footfall.streaming.forwarder import forwarder_writer, read_forwarded
from footfall.streaming.traffic import (
    StreamResult,
    accepted_event_stream,
    dead_letter_stream,
    intake_events,
    intake_stream,
    run_query,
    state_rows,
    traffic_stream,
)
from footfall.streaming.versioned import read_versioned, versioned_writer

TRAFFIC_ROUND = ("total_dwell_time",)
TRAFFIC_COLUMNS = [f.name for f in TRAFFIC_STATS.fields]

# Late-data scenario: every bus record is delivered a second time
# LATE_BY_SLICES slices (15 days) after it was due, while the replay still
# runs. Three slices, not two: the late-row filter of a micro-batch uses the
# watermark of the batch before it, which trails the data by a whole slice.
LATE_BY_SLICES = 3
SCATTERED = 4  # batches that the events of every key are scattered over (q29)


def _parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def replay_envelopes(spark: SparkSession, sf_dir: str, late_copies: bool = False) -> DataFrame:
    """Bus envelopes of all events with their replay slice; optionally every
    record again, ``LATE_BY_SLICES`` slices later, with half its dwell time, so
    that a late copy which is accepted shows in the totals. Copies of the last
    slices arrive after all else."""
    env = bus_envelope(spark, sf_dir).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    if late_copies:
        late = bus_envelope(spark, sf_dir, dwell_scale=0.5)
        late = late.withColumn("slice", replay_slice(F.unix_millis("timestamp")) + LATE_BY_SLICES)
        env = env.unionByName(late)
    return env


def replay_input(spark: SparkSession, sf_dir: str, late_copies: bool) -> tuple[str, int]:
    """Fresh folder of replay files for ``sf_dir`` and the files per slice."""
    path = os.path.join(scratch_path(spark, "replay"), "input")
    files = _parallelism(spark)
    write_replay_files(replay_envelopes(spark, sf_dir, late_copies), path, files_per_slice=files)
    return path, files


def replay_traffic(
    spark: SparkSession,
    sf_dir: str,
    kind: str,
    output_mode: str = "update",
    late_copies: bool = False,
) -> tuple[str, StreamResult]:
    """Write the replay files, run the traffic stream over them to the end
    and return the change-log path and the run summary."""
    root = scratch_path(spark, kind)
    source, files = replay_input(spark, sf_dir, late_copies)
    stream = envelope_file_stream(spark, source, max_files_per_trigger=files)
    changelog = os.path.join(root, "changelog")
    # Update mode needs the idempotent foreachBatch writer; append mode uses
    # Spark's exactly-once parquet file sink.
    sink = changelog if output_mode == "append" else changelog_batch_writer(changelog)
    result = run_query(
        spark,
        traffic_stream(stream),
        sink,
        os.path.join(root, "checkpoint"),
        output_mode=output_mode,
        state_partitions=_parallelism(spark),
    )
    return changelog, result


def q17_stream_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode stream over the replayed bus; the current table (latest
    change-log row per key) equals the batch aggregate."""
    changelog, _ = replay_traffic(spark, sf_dir, "q17_stream_traffic")
    return present(latest_per_key(read_changelog(spark, changelog)), TRAFFIC_ROUND)


def q18_idempotent_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the change log, then deliver its first batch again through the
    micro-batch sink (a retried batch): every change-log row is stored once."""
    from footfall.plans.catalogue import traffic_changelog

    path = os.path.join(scratch_path(spark, "q18_idempotent_sink"), "changelog")
    log = traffic_changelog(spark, sf_dir, batch_ms=DEFAULT_SLICE_MS)
    write_changelog(log, path)
    # A retry recomputes the batch from its source; only its id comes from the table.
    b0 = read_changelog(spark, path).agg(F.min(BATCH_ID)).first()[0]
    retried = log.filter(F.col(BATCH_ID) == F.lit(b0)).drop(BATCH_ID)
    changelog_batch_writer(path)(retried, b0)
    return present(read_changelog(spark, path).select(BATCH_ID, *TRAFFIC_COLUMNS), TRAFFIC_ROUND)


def q19_bus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish events as bus records (key = topic, value = JSON), read the
    records back and parse them: the round trip is lossless."""
    path = os.path.join(scratch_path(spark, "q19_bus_records"), "records")
    events = sensor_events(spark, sf_dir).withColumn("topic", topic_for_store(F.col("store_id")))
    write_bus_records(events, path)
    records = spark.read.schema("topic string, key binary, value binary").parquet(path)
    return decode_envelope(records, carry=[]).select(*SENSOR_EVENT_FIELDS)


def q20_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay in which every record comes again late with another dwell time:
    the watermark drops the copies but for those of windows that are still open
    at the end, which add to their totals."""
    changelog, _ = replay_traffic(spark, sf_dir, "q20_late_data", late_copies=True)
    return present(latest_per_key(read_changelog(spark, changelog)), TRAFFIC_ROUND)


def q22_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: each window is written once, when the watermark closes it."""
    closed, _ = replay_traffic(spark, sf_dir, "q22_closed_windows", output_mode="append")
    return present(spark.read.parquet(closed).select(*TRAFFIC_COLUMNS), TRAFFIC_ROUND)


def q23_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the partitioned catalog table, append the traffic rows to it and
    read it back by name."""
    from footfall.plans.catalogue import traffic_current

    root = scratch_path(spark, "q23_table_append")
    name = ensure_traffic_table(
        spark, "footfall_catalogue", f"traffic_{uuid.uuid4().hex}",
        location=os.path.join(root, "table"), database_location=os.path.join(root, "db"),
    )
    append_to_table(traffic_current(spark, sf_dir), name)
    return present(spark.table(name).select(*TRAFFIC_COLUMNS), TRAFFIC_ROUND)


def folded_table(spark: SparkSession, sf_dir: str, kind: str, batches: int = 4) -> str:
    """Path of a current table folded twice, from a change log in which events
    reach their batches in no order of time: the second fold updates rows of
    the first."""
    from footfall.plans.catalogue import clean_timed_events

    root = scratch_path(spark, kind)
    log, table = os.path.join(root, "changelog"), os.path.join(root, "current")
    arrival = F.pmod(F.xxhash64("event_id"), F.lit(batches)).cast("long")
    rows = changelog_by_batch(clean_timed_events(spark, sf_dir).withColumn(BATCH_ID, arrival))
    for part in (F.col(BATCH_ID) < batches // 2, F.col(BATCH_ID) >= batches // 2):
        write_changelog(rows.filter(part), log)
        fold_changelog(spark, log, table)
    return table


def q24_folded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current table after two folds of the change log."""
    table = read_current(spark, folded_table(spark, sf_dir, "q24_folded_table"))
    return present(table.select(*TRAFFIC_COLUMNS), TRAFFIC_ROUND)


def q25_live_visitors_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q11 from the stored current table, of which only the newest date is read."""
    return present(live_visitors(read_newest_date(spark, folded_table(spark, sf_dir, "q25_live"))))


def q26_store_performance_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q12 from the stored current table."""
    return present(store_performance(read_current(spark, folded_table(spark, sf_dir, "q26_stores"))), TRAFFIC_ROUND)


def q27_zone_share_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q13 from the stored current table."""
    return zone_share(read_current(spark, folded_table(spark, sf_dir, "q27_zones")))


def q28_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead-letter sink of a replayed bus with transport faults: what the
    stream rejects, with the first failing check."""
    root = scratch_path(spark, "q28_dead_letters")
    env = bus_envelope(spark, sf_dir, faults=True).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    files = _parallelism(spark)
    source, out = os.path.join(root, "input"), os.path.join(root, "rejected")
    write_replay_files(env, source, files_per_slice=files)
    rejected = dead_letter_stream(envelope_file_stream(spark, source, max_files_per_trigger=files))
    run_query(spark, rejected, out, os.path.join(root, "checkpoint"), output_mode="append")
    return spark.read.parquet(out).select("offset", "topic", "reject_reason")


def q29_stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change log of a stream in which the events of a key arrive
    over several batches: running totals per batch and key. The stream is
    resumed from its checkpoint for every batch."""
    root = scratch_path(spark, "q29_stream_changelog")
    source, log = os.path.join(root, "input"), os.path.join(root, "changelog")
    env = bus_envelope(spark, sf_dir).withColumn("slice", F.pmod("offset", F.lit(SCATTERED)))
    for _ in replay_steps(env, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        run_query(
            spark,
            traffic_stream(stream, watermark_delay="3650 days", window_duration="1 day"),
            changelog_batch_writer(log),
            os.path.join(root, "checkpoint"),
            state_partitions=_parallelism(spark),
        )
    return present(read_changelog(spark, log).select(BATCH_ID, *TRAFFIC_COLUMNS), TRAFFIC_ROUND)


def intake_table(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of the intake table of a replayed bus with transport faults."""
    root = scratch_path(spark, kind)
    source, out = os.path.join(root, "input"), os.path.join(root, "intake")
    env = bus_envelope(spark, sf_dir, faults=True).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    files = _parallelism(spark)
    write_replay_files(env, source, files_per_slice=files)
    rows = intake_stream(envelope_file_stream(spark, source, max_files_per_trigger=files))
    run_query(spark, rows, out, os.path.join(root, "checkpoint"), output_mode="append", partition_by="rejected")
    return out


def q30_intake_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the bus in the intake table, once, accepted or with its reject reason."""
    table = spark.read.schema(INTAKE).parquet(intake_table(spark, sf_dir, "q30_intake_table"))
    return table.select("offset", "topic", "rejected", "reject_reason")


def q31_intake_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic stream over the accepted part of an intake table: current table."""
    root = scratch_path(spark, "q31_intake_traffic")
    accepted = intake_events(spark, intake_table(spark, sf_dir, "q31_intake_table"))
    log = os.path.join(root, "changelog")
    run_query(
        spark, aggregate_traffic(accepted), changelog_batch_writer(log), os.path.join(root, "checkpoint"),
        state_partitions=_parallelism(spark),
    )
    return present(latest_per_key(read_changelog(spark, log)), TRAFFIC_ROUND)


def q32_once_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly-once table append of a stream whose events reach four batches: the
    writer of one batch is lost between write and commit, the stream resumes, and
    at the end a batch is delivered a second time. The current row per key."""
    root = scratch_path(spark, "q32_once_table")
    source, table = os.path.join(root, "input"), os.path.join(root, "table")
    lost: list[int] = []

    def lose_one(batch_id: int) -> None:
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise RuntimeError("writer lost before its commit")

    env = bus_envelope(spark, sf_dir).withColumn("slice", F.pmod("offset", F.lit(SCATTERED)))
    for n in replay_steps(env, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        job = dict(checkpoint=os.path.join(root, "checkpoint"), state_partitions=_parallelism(spark))
        rows = traffic_stream(stream, watermark_delay="3650 days")
        try:
            run_query(spark, rows, once_table_writer(table, lose_one), **job)
        except Exception:
            if n != 1 or lost != [1]:
                raise
            run_query(spark, rows, once_table_writer(table, lose_one), **job)
    first = read_once_table(spark, table, latest=False).filter(F.col(BATCH_ID) == 0)
    again = append_once(first.select(*TRAFFIC_COLUMNS), 0, table, first.first()[RUN])
    if again or not lost:
        raise RuntimeError("a batch was appended twice, or no writer was lost")
    return present(read_once_table(spark, table), TRAFFIC_ROUND)


# Planted faults of the offset audit: of every thousand offsets, some never
# arrive and some arrive a second time, in another batch.
MISSING, TWICE = (500, 509), (200, 204)
AUDIT_BLOCK = 250  # offsets that reach the same batch


def accounted_table(spark: SparkSession, env: DataFrame, kind: str) -> str:
    """Path of the accounted intake of envelopes that carry their ``slice``, one batch a slice."""
    root = scratch_path(spark, kind)
    source, table = os.path.join(root, "input"), os.path.join(root, "table")
    for _ in replay_steps(env, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        run_query(spark, accounted_records(stream), accounted_writer(table), os.path.join(root, "checkpoint"), output_mode="append")
    return table


def q33_offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and overlaps of the offsets that the committed batches of an intake
    have read, of a bus that loses some records and delivers others twice."""
    at = F.col("offset") % 1000
    batch = F.floor(F.col("offset") / AUDIT_BLOCK) % SCATTERED
    env = bus_envelope(spark, sf_dir).withColumn("topic", F.lit("sensor-traffic"))
    env = env.filter(~at.between(*MISSING)).withColumn("slice", batch)
    again = env.filter(at.between(*TWICE)).withColumn("slice", (batch + 1) % SCATTERED)
    table = accounted_table(spark, env.unionByName(again), "q33_offset_audit")
    found = audit_intervals(read_intervals(spark, table), ["partition"])
    return merged_findings(found, ["partition"]).select("kind", "first_offset", "last_offset")


def _late_intake(spark: SparkSession, sf_dir: str, kind: str, faults: bool) -> str:
    env = bus_envelope(spark, sf_dir, faults=faults).withColumn("slice", replay_slice(F.unix_millis("timestamp")))
    late = bus_envelope(spark, sf_dir, dwell_scale=0.5)
    late = late.withColumn("slice", replay_slice(F.unix_millis("timestamp")) + LATE_BY_SLICES)
    return accounted_table(spark, env.unionByName(late), kind)


def q34_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late records kept as dead letters, with their offset, reason and the
    watermark they were judged by, of a replay that delivers every record again late."""
    late = read_accounted(spark, _late_intake(spark, sf_dir, "q34_late_records", faults=False), LATE)
    return present(late.select("offset", "topic", "dwell_time_seconds", "reject_reason", "watermark"))


def q35_batch_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read, accepted, rejected and late of every batch of such a replay,
    with transport faults, and its watermark."""
    accounts = batch_accounts(spark, _late_intake(spark, sf_dir, "q35_batch_accounts", faults=True))
    return present(accounts.select(BATCH_ID, "read", "accepted", "rejected", "late", "watermark"))


def q37_state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic aggregation's state, read from its checkpoint: after the last
    batch of a replay, and after the batch that evicts the windows it closed."""
    root = scratch_path(spark, "q37_state_rows")
    source, log, checkpoint = (os.path.join(root, k) for k in ("input", "changelog", "checkpoint"))
    env = replay_envelopes(spark, sf_dir)
    newest = env.agg(F.max("slice")).first()[0]
    last = -1
    for n in replay_steps(env, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        last += 1
        run_query(
            spark, traffic_stream(stream), changelog_batch_writer(log), checkpoint,
            state_partitions=_parallelism(spark), evict_at_end=n == newest,
        )
    before = state_rows(spark, checkpoint, last).withColumn("phase", F.lit("open"))
    after = state_rows(spark, checkpoint).withColumn("phase", F.lit("evicted"))
    return present(before.unionByName(after), TRAFFIC_ROUND)


def q38_exact_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship aggregate with sums that do not depend on the order of events."""
    from footfall.plans.catalogue import clean_timed_events

    return present(aggregate_traffic_exact(clean_timed_events(spark, sf_dir)))


def q41_asof_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q40 by a stream: before each batch the campaigns that start in its days
    are added to the stores' versions, and the running query sees them."""
    root = scratch_path(spark, "q41_asof_stream")
    source, versions, table = (os.path.join(root, k) for k in ("input", "versions", "table"))
    campaigns = store_campaigns(spark, sf_dir).withColumn("_slice", replay_slice(F.unix_millis("valid_from")))
    known = campaigns.drop("_slice").schema
    last = -1
    for n in replay_steps(replay_envelopes(spark, sf_dir), source, files_per_slice=_parallelism(spark)):
        campaigns.filter(F.col("_slice").between(last + 1, n)).drop("_slice").write.mode("append").parquet(versions)
        last = n
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        events = accepted_event_stream(stream, watermark_delay=None).select("event_id", "store_id", "event_time")
        writer = versioned_writer(table, lambda s: s.read.schema(known).parquet(versions), ["store_id"])
        run_query(spark, events, writer, os.path.join(root, "checkpoint"), output_mode="append")
    columns = "event_id string, store_id string, event_time timestamp, valid_from timestamp, version long, campaign string"
    return present(read_versioned(spark, table, StructType.fromDDL(columns)))


def q42_ordered_forwarder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a forwarder has published, numbered per topic, of a bus with transport
    faults that delivers the last tenth of each batch again with the next; the
    writer of one batch is lost before its commit and the stream resumes."""
    root = scratch_path(spark, "q42_ordered_forwarder")
    source, table = os.path.join(root, "input"), os.path.join(root, "table")
    lost: list[int] = []

    def lose_one(batch_id: int) -> None:
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise RuntimeError("writer lost before its commit")

    env = bus_envelope(spark, sf_dir, faults=True)
    place = F.col("offset") * SCATTERED / (env.select(F.max("offset")).scalar() + 1)
    env = env.withColumn("slice", F.floor(place))
    again = env.filter((place - F.col("slice") >= 0.9) & (F.col("slice") < SCATTERED - 1))
    bus = env.unionByName(again.withColumn("slice", F.col("slice") + 1))
    for n in replay_steps(bus, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        job = dict(checkpoint=os.path.join(root, "checkpoint"), output_mode="append")
        try:
            run_query(spark, stream, forwarder_writer(table, lose_one), **job)
        except Exception:
            if n != 1 or lost != [1]:
                raise
            run_query(spark, stream, forwarder_writer(table, lose_one), **job)
    if not lost:
        raise RuntimeError("no writer was lost")
    text = F.decode("value", "UTF-8")
    fields = [F.get_json_object(text, f"$.{k}").alias(k) for k in ("event_id", "sensor_id", "gender")]
    return read_forwarded(spark, table).select("topic", "seq", "offset", *fields)


def q43_live_dashboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dashboards after every batch of a change log whose keys are
    corrected over four batches, kept by a stateful stream over that log."""
    root = scratch_path(spark, "q43_live_dashboards")
    source, log, places = (os.path.join(root, k) for k in ("input", "changelog", "places"))
    env = bus_envelope(spark, sf_dir).withColumn("slice", F.pmod("offset", F.lit(SCATTERED)))
    steps = 0
    for _ in replay_steps(env, source, files_per_slice=_parallelism(spark)):
        stream = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true").parquet(source)
        job = dict(state_partitions=_parallelism(spark))
        traffic = traffic_stream(stream, watermark_delay="3650 days", window_duration="1 day")
        run_query(spark, traffic, changelog_batch_writer(log), os.path.join(root, "checkpoint", "traffic"), **job)
        totals = place_totals(changelog_stream(spark, log), "3651 days")
        run_query(spark, totals, places_writer(places), os.path.join(root, "checkpoint", "dashboards"), **job)
        steps += 1
    shown = []
    for n in range(steps):
        held = read_places(spark, places, until=n)
        for kind, rows in (("live", live_visitors_now(held)), ("stores", store_performance_now(held)), ("zones", zone_share_now(held))):
            shown.append(rows.select(F.lit(n).cast("long").alias(BATCH_ID), F.lit(kind).alias("dashboard"), "*"))
    out = shown[0].unionByName(shown[1], allowMissingColumns=True).unionByName(shown[2], allowMissingColumns=True)
    for rows in shown[3:]:
        out = out.unionByName(rows, allowMissingColumns=True)
    return present(out, TRAFFIC_ROUND)


CLUSTER_FILES = 64  # files of the clustered table at least, however small it is
STORE, STORE_DAYS = "STORE_01", 7


def clustered_table(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of the traffic rows clustered by store, zone and time."""
    from footfall.plans.catalogue import traffic_current

    path = os.path.join(scratch_path(spark, kind), "table")
    rows = traffic_current(spark, sf_dir)
    write_clustered(rows, path, rows_per_file=min(ROWS_PER_FILE, max(1, rows.count() // CLUSTER_FILES)))
    return path


def q46_live_visitors_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q11 from the clustered table: the index names the newest window and the
    files that can hold it."""
    path = clustered_table(spark, sf_dir, "q46_live")
    return present(live_visitors(read_clustered(spark, path, since=newest_window(spark, path))))


def q47_store_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and dwell of one store over the last seven days, from the files
    that can hold its rows."""
    path = clustered_table(spark, sf_dir, "q47_store")
    newest = newest_window(spark, path)
    since = newest - dt.timedelta(days=STORE_DAYS) if newest else None
    return present(store_performance(read_clustered(spark, path, {"store_id": STORE}, since)), TRAFFIC_ROUND)


STREAMED = [
    q17_stream_traffic, q18_idempotent_sink, q19_bus_records, q20_late_data, q22_closed_windows, q23_table_append,
    q24_folded_table, q25_live_visitors_stored, q26_store_performance_stored, q27_zone_share_stored, q28_dead_letters,
    q29_stream_changelog, q30_intake_table, q31_intake_traffic, q32_once_table, q33_offset_audit, q34_late_records,
    q35_batch_accounts, q37_state_rows, q38_exact_traffic, q41_asof_stream, q42_ordered_forwarder,
    q43_live_dashboards,
    q43_live_dashboards, q46_live_visitors_clustered, q47_store_clustered,
]
