"""Session helpers: time zone pinning and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(
    master: str | None = None,
    app_name: str = "footfall",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators rely on.

    Hour-of-day and day-of-week flags are defined in UTC, so the session
    time zone is pinned rather than inherited from the JVM.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # Commit a state change log per batch instead of a full snapshot.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (a runtime setting, safe to repeat)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at storage all
    executors see; it is required there. Only a local-mode session (a unit
    test, a laptop) without it gets a local folder, created and registered
    as the checkpoint folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at shared storage (HDFS, S3, ...) "
            "for stream checkpoints, replay files and change logs"
        )
    path = tempfile.mkdtemp(prefix="footfall-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder under the shared folder for one run."""
    return os.path.join(shared_dir(spark), "footfall", kind, uuid.uuid4().hex)
