"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # timestamps are wall-clock values throughout
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # data errors raise, as they do in the warehouse
    "spark.sql.ansi.enabled": "true",
    # join sides are broadcast only when Spark finds them to be small, counting a
    # file as four times its compressed size; hot keys in larger joins are split
    # at run time, even where a later step then needs another shuffle
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors reach.

    Only a local session, whose executors are the driver, may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wardloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def build_session(app_name: str = "wardloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
