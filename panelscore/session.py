"""Session factory and the shared work folder.

Stages exchange tables through files, so every materialised table lives under the folder the cluster
names in ``spark.checkpoint.dir`` (a shared file system on a cluster). A local folder is created only
when that setting is absent and the master is local; on a cluster a missing setting is an error.
"""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    # checkpoints cut lineage; their files are removed once the checkpointed DataFrame is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app_name: str = "panelscore", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder; set from ``spark.checkpoint.dir`` or, if unset on a local master, a local one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(shared_folder(sc.master, spark.conf.get("spark.checkpoint.dir", None)))
    return sc.getCheckpointDir()


def shared_folder(master: str, configured: str | None) -> str:
    if configured:
        return configured
    if re.fullmatch(r"local(\[.*\])?", master):
        return tempfile.mkdtemp(prefix="panelscore-ckpt-")
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a table this library writes."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
