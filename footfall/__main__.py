"""Command line: ``python -m footfall stream ...`` runs the traffic job,
``python -m footfall fold ...`` folds what its change log gained into the
current table, ``python -m footfall compact ...`` rewrites the whole log as one, ``python -m footfall query <name> <sf_dir>`` runs one catalogue query.

Cluster settings (master, memory, shuffle partitions, spark.checkpoint.dir)
come from spark-submit / spark-defaults; only the time zone is pinned.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from footfall.fixed import TRIGGER_INTERVAL, WATERMARK_DELAY, WINDOW_DURATION
from footfall.session import ensure_utc


def _session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_utc(spark)
    return spark


def _stream(args: argparse.Namespace) -> int:
    from footfall.sources.bus import kafka_envelope_stream
    from footfall.sources.replay import envelope_file_stream
    from footfall.streaming.job import TrafficJobConfig, await_job, start_traffic_job

    spark = _session("footfall-traffic")
    if args.kafka_servers:
        envelopes = kafka_envelope_stream(
            spark,
            args.kafka_servers,
            args.topic,
            starting_offsets=args.starting_offsets,
            fail_on_data_loss=args.fail_on_data_loss,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
            group_id_prefix=args.group_id_prefix,
            options=dict(o.split("=", 1) for o in args.kafka_option),
        )
    else:
        envelopes = envelope_file_stream(spark, args.replay_dir, args.max_files_per_trigger)
    cfg = TrafficJobConfig(
        changelog_path=args.changelog,
        checkpoint_root=args.checkpoint,
        dead_letter_path=args.dead_letters,
        intake_path=args.intake,
        table_path=args.table,
        accounted_path=args.accounted,
        watermark_delay=args.watermark,
        window_duration=args.window,
        trigger_interval=args.trigger,
        output_mode=args.output_mode,
        idempotent=not args.plain_append,
        dedup=args.dedup,
        max_future_skew_ms=args.max_future_skew_ms,
        state_partitions=args.state_partitions,
        available_now=args.available_now,
    )
    log = logging.getLogger("footfall")
    try:
        started = start_traffic_job(spark, envelopes, cfg)
        if not args.available_now:
            await_job(spark, started)
        else:
            for res in started:
                log.info("finished: %s", res)
    except Exception:
        # Any failure: log it, stop the session, exit non-zero so the
        # supervisor restarts the job (queries resume from their checkpoints).
        log.exception("traffic job failed")
        if not args.keep_session:
            spark.stop()
        return 1
    return 0


def _compact(args: argparse.Namespace) -> int:
    from footfall.sinks.tables import compact_changelog

    spark = _session("footfall-compact")
    current = compact_changelog(spark, args.changelog, args.out)
    logging.getLogger("footfall").info("current table written to %s", args.out)
    if args.show:
        current.orderBy("window_start", "store_id", "zone_id").show(args.show, truncate=False)
    return 0


def _fold(args: argparse.Namespace) -> int:
    from footfall.sinks.current import expire_folded, fold_changelog

    spark = _session("footfall-fold")
    log = logging.getLogger("footfall")
    log.info("dates written: %s", fold_changelog(spark, args.changelog, args.table))
    if args.expire:
        log.info("folders deleted: %s", len(expire_folded(spark, args.changelog, args.table, args.keep)))
    return 0


def _query(args: argparse.Namespace) -> int:
    from footfall.plans import catalogue

    spark = _session("footfall-query")
    df = catalogue()[args.name](spark, args.sf_dir)
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
    else:
        df.show(args.show, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    """Parse the command line and run the chosen sub-command."""
    p = argparse.ArgumentParser(prog="footfall")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="run the streaming traffic job")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka-servers")
    src.add_argument("--replay-dir", help="folder of envelope parquet files (one micro-batch per file)")
    s.add_argument("--topic", default="sensor-events")
    s.add_argument("--starting-offsets", default="latest", choices=["earliest", "latest"])
    s.add_argument("--fail-on-data-loss", action="store_true")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--min-partitions", type=int)
    s.add_argument("--group-id-prefix")
    s.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE", help="reader option, such as kafka.security.protocol=SSL")
    s.add_argument("--max-files-per-trigger", type=int, default=1)
    s.add_argument("--changelog", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--dead-letters")
    s.add_argument("--intake", help="instead of --dead-letters: table of accepted and rejected records, parsed once")
    s.add_argument("--table", help="also append each batch exactly once to this table")
    s.add_argument("--accounted", help="every record as accepted, rejected or late, with counts and offsets per batch")
    s.add_argument("--watermark", default=WATERMARK_DELAY)
    s.add_argument("--window", default=WINDOW_DURATION)
    s.add_argument("--trigger", default=TRIGGER_INTERVAL)
    s.add_argument("--output-mode", default="update", choices=["update", "append"])
    s.add_argument("--plain-append", action="store_true", help="at-least-once sink instead of per-batch overwrite")
    s.add_argument("--dedup", action="store_true")
    s.add_argument("--max-future-skew-ms", type=int)
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--keep-session", action="store_true", help=argparse.SUPPRESS)  # embedding / tests
    s.set_defaults(func=_stream)

    c = sub.add_parser("compact", help="rewrite a change log as the current table (by window_date)")
    c.add_argument("--changelog", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--show", type=int, default=0)
    c.set_defaults(func=_compact)

    f = sub.add_parser("fold", help="fold new batches of a change log into the current table")
    f.add_argument("--changelog", required=True)
    f.add_argument("--table", required=True)
    f.add_argument("--expire", action="store_true", help="then delete folded batches and replaced dates")
    f.add_argument("--keep", type=int, default=2, help="folds whose replaced dates stay for their readers")
    f.set_defaults(func=_fold)

    q = sub.add_parser("query", help="run one catalogue query")
    q.add_argument("name")
    q.add_argument("sf_dir")
    q.add_argument("--output")
    q.add_argument("--show", type=int, default=20)
    q.set_defaults(func=_query)

    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    return args.func(args)


if __name__ == "__main__":
    sys.exit(main())
