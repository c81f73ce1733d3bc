"""Events joined, batch by batch, to the dimension versions known by then."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from footfall.operators.asof import asof_left_join
from footfall.operators.changelog import BATCH_ID, RUN
from footfall.sinks.ledger import ATTEMPT, CommitLedger, append_once
from footfall.sinks.tables import run_of


def versioned_writer(
    path: str, read_versions: Callable[[SparkSession], DataFrame], keys: list[str], time_col: str = "event_time"
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends each micro-batch, with the version
    valid at each event's time, exactly once. ``read_versions`` is called for
    every batch, so versions that are added while the stream runs are seen from
    the next batch on; a late event still gets the version of its own time."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, f"{path.rstrip('/')}/ledger")
        batch.persist()  # sized and joined
        try:
            joined = asof_left_join(batch, read_versions(batch.sparkSession), keys, time_col)
            append_once(joined, batch_id, path, run, partition_by=())
        finally:
            batch.unpersist()

    return sink


def read_versioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of committed batches."""
    rows = CommitLedger(spark, path).read(StructType(list(schema.fields)).add(ATTEMPT, "string"))
    return rows.drop(RUN, BATCH_ID)
