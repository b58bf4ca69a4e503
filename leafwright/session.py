"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "leafwright", **settings: str) -> SparkSession:
    """A session with the settings the jobs expect; the master comes from the submit command."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder.

    The cluster names the folder in ``spark.checkpoint.dir``.  Only in local
    mode, as in tests, a local folder is made where that is unset; elsewhere
    each executor would write to a disk of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="leafwright-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the work folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
