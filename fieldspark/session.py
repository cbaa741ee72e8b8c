"""Session settings that the operators rely on."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def session(name: str = "fieldspark", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; merged maps keep the right side's value."""
    builder = SparkSession.builder.appName(name)
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also when it isn't installed there."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), ROOT]))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a local session does without the setting."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if "cluster" in spark.sparkContext.master or not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file:///tmp/checkpoints/fieldspark"
    return at.rstrip("/")


_kept: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/fieldspark-{name}-{uuid.uuid4().hex}"
    _kept.append((spark, path))
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as libraries beside Spark read it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def kept(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: its lineage ends there."""
    spark, schema = df.sparkSession, df.schema
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@atexit.register
def _forget() -> None:
    for spark, path in _kept:
        with contextlib.suppress(Exception):  # the session may have ended before: the cluster's own clean-up remains
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
