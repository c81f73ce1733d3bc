"""File replay of a message bus, for tests, benchmarks and back-fills.

An envelope DataFrame is cut into time-ordered slices; each slice is written
as its own set of files under ``<root>/slice=<n>``. A file stream source
reading the folder with ``maxFilesPerTrigger`` then replays the bus one
micro-batch per file, oldest first.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schemas import ENVELOPE

DAY_MS = 86_400_000
DEFAULT_SLICE_MS = 5 * DAY_MS


def replay_slice(ms: Column | str, slice_ms: int = DEFAULT_SLICE_MS) -> Column:
    """Epoch-aligned slice number of an epoch-millisecond column."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(c / F.lit(slice_ms)).cast("long")


def replay_steps(
    envelope: DataFrame,
    root: str,
    slice_col: str = "slice",
    files_per_slice: int = 1,
) -> Iterator[int]:
    """Write ``envelope`` (which carries ``slice_col``) as one folder per slice,
    in slice order; yields each slice number once its files are there. A stream
    that is run to its end at every step takes exactly one slice a micro-batch,
    however many files hold it.

    The envelope is first staged once, partitioned by slice (one parallel
    job). Each slice is then copied by its own job, reading only its staged
    partition, so file modification times follow slice order;
    ``files_per_slice`` files per slice are written in parallel. Only the
    distinct slice numbers (a handful) come back to the driver.
    """
    spark = envelope.sparkSession
    staging = os.path.join(root, "_staging")
    cols = [f.name for f in ENVELOPE.fields]
    envelope.select(slice_col, *cols).write.mode("overwrite").partitionBy(slice_col).parquet(staging)
    staged = spark.read.parquet(staging)
    slices = sorted(r[0] for r in staged.select(slice_col).distinct().collect())
    for n in slices:
        part = staged.filter(F.col(slice_col) == n).select(*cols)
        part.repartition(files_per_slice).write.mode("overwrite").parquet(
            os.path.join(root, f"{slice_col}={n:012d}")
        )
        time.sleep(0.01)  # distinct modification times between slices
        yield n


def write_replay_files(
    envelope: DataFrame,
    root: str,
    slice_col: str = "slice",
    files_per_slice: int = 1,
) -> list[int]:
    """Write all slices (see ``replay_steps``) and return their numbers. Every
    slice has exactly ``files_per_slice`` files, empty ones if it has too few
    rows, so a stream that takes that many files a trigger takes one slice."""
    spark, numbers = envelope.sparkSession, []
    for n in replay_steps(envelope, root, slice_col, files_per_slice):
        folder = os.path.join(root, f"{slice_col}={n:012d}")
        held = len(spark.read.schema(ENVELOPE).parquet(folder).inputFiles())
        for _ in range(files_per_slice - held):
            spark.createDataFrame([], ENVELOPE).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.01)
        numbers.append(n)
    return numbers


def envelope_file_stream(
    spark: SparkSession,
    root: str,
    max_files_per_trigger: int = 1,
    ignore_missing_files: bool = True,
) -> DataFrame:
    """Stream the replay folder as envelopes, one file per trigger by default.

    The staging folder is skipped (names starting with ``_`` are hidden).
    ``ignore_missing_files`` is the file analogue of not failing on data
    loss: a file removed after it was listed is skipped, not fatal.
    """
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", str(bool(ignore_missing_files)).lower())
        .parquet(root)
    )
