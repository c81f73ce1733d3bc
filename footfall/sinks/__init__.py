"""Sinks: change-log and snapshot tables, dead letters, bus records."""

from footfall.sinks.current import expire_folded, fold_changelog, read_current, read_newest_date
from footfall.sinks.ledger import CommitLedger, append_once, expire_attempts, once_table_writer, read_once_table
from footfall.sinks.tables import (
    append_changelog_batch,
    append_to_table,
    bus_records,
    publish_to_kafka,
    changelog_batch_writer,
    compact_changelog,
    ensure_traffic_table,
    forwarded_records,
    read_changelog,
    register_traffic_view,
    write_bus_records,
    write_changelog,
    write_changelog_batch,
)

__all__ = [
    "CommitLedger",
    "append_once",
    "expire_attempts",
    "once_table_writer",
    "read_once_table",
    "append_changelog_batch",
    "append_to_table",
    "bus_records",
    "publish_to_kafka",
    "changelog_batch_writer",
    "compact_changelog",
    "ensure_traffic_table",
    "expire_folded",
    "fold_changelog",
    "forwarded_records",
    "read_changelog",
    "read_current",
    "read_newest_date",
    "register_traffic_view",
    "write_bus_records",
    "write_changelog",
    "write_changelog_batch",
]
