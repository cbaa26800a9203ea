"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed value: size at which files are rolled over. Adaptive execution takes it as
# the target size of a task, so the rebalance before a write cuts files there.
ROLLOVER_BYTES = 115_000_000

SQL_SETTINGS = {
    # Hour keys and date directories are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A write of many small directories costs by the file, not by the byte: small
    # shuffles are still cut into a task for each core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ROLLOVER_BYTES),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this package relies on."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "rillflow", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local-mode session, where every
    task sees the same disk, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="rillflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
