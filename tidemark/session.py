"""Spark session with the settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Partition values stay strings: ``1d`` would otherwise be read as a number.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def shared_scratch(spark: SparkSession) -> str:
    """The folder for tables of a run: that of ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting gets a folder of this machine.
    """
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "tidemark", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
