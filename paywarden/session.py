"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Target size of a shuffled partition, and so of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods above this size; generated code that is longer
    # runs faster split into operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed state (ids seen, open windows) lives on executor disk, not heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str, **conf: str) -> SparkSession:
    """Session for the jobs; master and sizing come from spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, or the checkpoint folder set on the context.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def require_utc(spark: SparkSession) -> None:
    """Days, windows and date folders are those of UTC; a job refuses to start elsewhere."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")
