"""Session settings the library relies on."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import SparkSession

from tidelog.sinks.catalog import LakeCatalog, merged_conf

# Runtime settings: they may be set on a session somebody else has built.
RUNTIME_CONF = {
    # TIMESTAMP_LTZ and zone-less timestamps convert into each other in UTC.
    "spark.sql.session.timeZone": "UTC",
    # partition_date is a string; inference would turn the directory name into a DATE.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # One device may own a third of all readings: let AQE split its partition,
    # also where the next operator then needs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task keeps that many days open at a time; only beyond it are rows sorted by day before they are written.
    "spark.sql.maxConcurrentOutputFileWriters": "40",
    # Stream state lives in RocksDB, outside the heap, and is saved as change logs.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A streaming join keeps its four state tables in one store per partition, not in four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "tidelog", master: str | None = None,
                  conf: dict[str, str] | None = None, catalogs: Collection[LakeCatalog] = ()) -> SparkSession:
    """Start (or get) a session, with the lake's catalogs. Cluster sizing stays with ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**merged_conf(catalogs), **(conf or {})}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    In local mode (tests) a folder of our own will do where none is named. On a cluster a
    machine's own temporary folder would be lost with the machine, so a name is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"/tmp/tidelog-{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
