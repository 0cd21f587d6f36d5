"""Session settings the library relies on, and the shared folder for durable intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Whether a state store uploads the changes of a batch, or its new files.
CHANGELOG_SETTING = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# Settings that change results or plan quality; all of them can be set on a running session.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.schemaInference": "false",
    # Deduplication and window state live on disk and are uploaded as changes, not held on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    CHANGELOG_SETTING: "true",
    # Else every state partition allots 4 MB of disk before it holds anything.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_SETTINGS` to an existing session and return it."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", app_name: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and the bench."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every expression slows plan building down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave that setting out; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
