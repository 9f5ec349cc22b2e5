"""Intermediate tables in the shared checkpoint folder.

Operators cut lineage by writing a Parquet table under ``spark.checkpoint.dir``
and reading it back: every executor sees the files, so a lost executor costs
only its own running tasks. Local folders are used only where the setting is
absent, as in unit tests on ``local[N]``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or one made for a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tidemark.scratch", None)
    if not root and (held := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        root = held.get()  # set on the context alone
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.tidemark.scratch", root)
    return root.rstrip("/")


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"
    # the write's own shuffle files are of no use once it has committed
    cleanup = "spark.sql.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, before)
    saved = spark.read.schema(df.schema).parquet(path)
    saved.written_to = path
    return saved


def discard(saved: DataFrame) -> None:
    """Delete the table behind what ``save`` returned; nothing may read it any more."""
    spark = saved.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(saved.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
