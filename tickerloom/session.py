"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings the results or the plans rely on. Cluster sizing (executors,
# memory, initial shuffle partitions) belongs to the submit command.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}


def get_spark(app: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session; ``conf`` keys use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partitions for an input size.

    AQE merges small partitions but never adds any to an ordinary shuffle, so the initial
    number must be high enough for the largest shuffle. What jobs here shuffle is mostly aggregated
    before, so a caller may pass the bytes that are left then.
    """
    return max(8, -(-input_bytes // target_bytes))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for written intermediates, in the folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local-mode session
    without that setting gets a temporary folder; a cluster must name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="run-tickerloom-")
            _local_roots[context.applicationId] = root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
