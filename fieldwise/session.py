"""Session settings the engine relies on.

The engine never owns the cluster: it takes whatever ``SparkSession`` the
caller has and only pins the few *SQL* settings its semantics depend on
(UTC session zone, map-key dedup policy). Cluster sizing, shuffle partitions
and the checkpoint folder stay with the caller; ``local_session`` exists for
tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantics, not tuning: every instant is stored in UTC, zone work is explicit.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A report row completed with a header template keeps the real cell.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def ensure_semantics(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings whose values change results."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage (``spark.checkpoint.dir``).

    On a cluster the setting names shared storage and is used as is (and an
    unset setting is an error). Only a local master (tests, a laptop) gets a
    scratch folder made here when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would not survive a lost executor or driver
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for streaming state and checkpoints")
        configured = tempfile.mkdtemp(prefix="fieldwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a lineage cut
    that is computed once and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: int | None = None, app: str = "fieldwise") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FIELDWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SEMANTIC_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_semantics(spark)
