"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a large cluster should run with. AQE splits skewed join partitions and merges small
# ones, so the initial partition number may be generous.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A task that writes to few partition folders keeps their files open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
}

_local_roots: dict[str, str] = {}


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """Single-JVM session for tests and benchmarks; on a cluster the caller brings the session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tillwatch")
    settings = {
        **CLUSTER_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def child_session(spark: SparkSession) -> SparkSession:
    """A session of its own on the same context, with the caller's runtime settings."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for ``name`` below the folder set in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a cluster a
    machine-local folder would lose the data with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="tillwatch-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/tillwatch/{name}-{uuid.uuid4().hex}"
