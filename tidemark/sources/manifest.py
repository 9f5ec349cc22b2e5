"""Files of the lake with size and modification time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import SPECS
from tidemark.sources.lake import Scope
from tidemark.sources.paths import partitions_of

_SCHEMA = "file_rel string, market string, dataset string, file_path string, file_size_bytes long, mtime_ns long, symbol string, date string, month string, timeframe string"


def _walk(spark: SparkSession, path: str) -> Iterable[tuple[str, int, int]]:
    """(path, bytes, modification time in ns) of data files, through whatever store the path is in."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return
    local = fs.getScheme() == "file"
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()
        if name.endswith(".parquet") and "/_" not in name[len(path) :]:
            ns = f.getModificationTime() * 1_000_000
            if local:  # Hadoop's times have milliseconds only
                import os

                name = name.removeprefix("file:")
                name = "/" + name.lstrip("/")
                ns = os.stat(name).st_mtime_ns
            yield name, f.getLen(), ns


def _within(parts: dict[str, str], scope: Scope) -> bool:
    if scope.symbols is not None and parts.get("symbol") not in scope.symbols:
        return False
    n = 10 if "date" in parts else 7
    at = parts.get("date", parts.get("month", ""))
    return not (scope.start and at < f"{scope.start:%Y-%m-%d}"[:n]) and not (scope.end and at > f"{scope.end:%Y-%m-%d}"[:n])


def scan_files(spark: SparkSession, root: str, datasets: Iterable[str], timeframe: str = "1m", market: str = "futures", scope: Scope | None = None) -> DataFrame:
    """One row per data file in scope; funding, without a timeframe, only in one-minute scans."""
    root, scope, rows = str(root).rstrip("/"), scope or Scope(), []
    for dataset in datasets:
        spec = SPECS[dataset]
        if not spec.has_timeframe and timeframe not in ("1m", "*"):
            continue
        base = f"{root}/{market}/{dataset}" + (f"/timeframe={timeframe}" if spec.has_timeframe and timeframe != "*" else "")
        for path, size, mtime in _walk(spark, base):
            parts = partitions_of(path[len(root) :])
            if _within(parts, scope):
                rows.append((path[len(root) + 1 :], market, dataset, path, size, mtime, parts.get("symbol"), parts.get("date"), parts.get("month"), parts.get("timeframe", "")))
    return spark.createDataFrame(sorted(rows), _SCHEMA)


def merged_manifest(old: DataFrame, now: DataFrame, at) -> DataFrame:
    """The manifest with ``now`` in it: the time first seen stays, the time last seen is ``at``."""
    from tidemark.operators.tables import upsert

    names = ["file_rel", "market", "dataset", "file_path", "file_size_bytes", "mtime_ns"]
    stamped = now.select(*names, F.lit(at).cast("timestamp").alias("first_seen_utc"), F.lit(at).cast("timestamp").alias("last_seen_utc"))
    return upsert(old, stamped, ["file_rel"], keep=["first_seen_utc"])
