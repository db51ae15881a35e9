"""Session factory and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, adaptive execution and RocksDB streaming state.

    Shuffle partitions are left to the cluster's own setting unless given in ``conf``;
    adaptive execution merges small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without it and gets a temporary folder; on a cluster a
    machine-local folder would not be visible to the other executors, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidewater-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/tidewater/{label}-{uuid.uuid4().hex}"
