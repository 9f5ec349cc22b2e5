"""Readers and writers of lake datasets and metadata tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import month_starts
from tidemark.schemas import KEYS, SPECS, TABLES


@dataclass(frozen=True)
class Scope:
    """Symbols and days, both ends included, that a run is about; None for all."""

    symbols: tuple[str, ...] | None = None
    start: date | None = None
    end: date | None = None

    @property
    def open(self) -> bool:
        return self.symbols is None and self.start is None and self.end is None

    def on(self, symbol: str | None = "symbol", day: str | None = "date") -> Column:
        """As a predicate; partition columns of strings compare in the same order as days."""
        test = F.lit(True)
        if symbol and self.symbols is not None:
            test = test & F.col(symbol).isin(list(self.symbols))
        if day and self.start is not None:
            test = test & (F.col(day) >= F.lit(f"{self.start:%Y-%m-%d}"))
        if day and self.end is not None:
            test = test & (F.col(day) <= F.lit(f"{self.end:%Y-%m-%d}"))
        return test

    def on_month(self, month: str = "month") -> Column:
        """Months that overlap the days."""
        test = self.on(day=None)
        if self.start is not None:
            test = test & (F.col(month) >= F.lit(f"{self.start:%Y-%m}"))
        if self.end is not None:
            test = test & (F.col(month) <= F.lit(f"{self.end:%Y-%m}"))
        return test


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: Patterns of folders that a read is narrowed to at most; beyond them the whole dataset is listed.
MOST_PATTERNS = 200


def _narrowed(spark: SparkSession, path: str, scope: Scope, parted: str) -> list[str]:
    """Folder patterns for a scope's symbols and months, those that match something; else the path itself."""
    months = [f"{m:%Y-%m}" for m in month_starts(scope.start, scope.end)] if scope.start and scope.end else ["*"]
    if scope.symbols is None and months == ["*"] or len(months) * len(scope.symbols or "*") > MOST_PATTERNS:
        return [path]
    tails = ["*"] if months == ["*"] else months if parted == "month" else [f"{m}-*" for m in months]
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = [f"{path}/symbol={s}/{parted}={t}" for s in scope.symbols or ["*"] for t in tails]
    return [w for w in wanted if fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(w))] or [path]


def read_dataset(spark: SparkSession, root: str, dataset: str, timeframe: str = "1m", market: str = "futures", scope: Scope | None = None) -> DataFrame | None:
    """Rows of a dataset with its partition columns as strings and ``file``; None if it is not there.

    Only the subtree of one timeframe is read, as days and months must not be mixed.
    Files of other schemas are united by name, which reads their footers: so folders are
    narrowed by symbol and month before, and filtered by day after.
    """
    base = f"{str(root).rstrip('/')}/{market}/{dataset}"
    spec = SPECS[dataset]
    path = f"{base}/timeframe={timeframe}" if spec.has_timeframe else base
    if not exists(spark, path):
        return None
    scope = scope or Scope()
    parted = "month" if spec.has_timeframe and timeframe != "1m" else "date"
    df = spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*_narrowed(spark, path, scope, parted))
    if "timeframe" not in df.columns:
        df = df.withColumn("timeframe", F.lit(""))
    df = df.where(scope.on_month() if parted == "month" else scope.on(day="date"))
    return df.withColumn("file", F.col("_metadata.file_path"))


def day_column(df: DataFrame, dataset: str, timeframe: str) -> Column:
    """The day of a row: that of its folder for raw rows, never of its time; the file's own for derived bars."""
    if timeframe == "1m" or dataset == "funding":
        return F.to_date("date")
    from tidemark.functions.exprs import day_key

    return day_key(df)


def write_partitioned(df: DataFrame, root: str, dataset: str, market: str = "futures", overwrite: bool = True) -> None:
    """Write rows under their partition folders, replacing only folders that get rows.

    Rows are dealt by partition, so a folder is written by one task, in one file.
    """
    spec = SPECS[dataset]
    tail = ["month"] if "month" in df.columns else ["date"]
    keys = [*(["timeframe"] if spec.has_timeframe else []), "symbol", *tail]
    if not spec.has_timeframe:
        df = df.drop("timeframe")
    df.repartition(*keys).sortWithinPartitions(*keys).write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(f"{str(root).rstrip('/')}/{market}/{dataset}")


#: Versions of a table that stay, for readers that hold an older one.
RETAIN = 5


class MetaStore:
    """Metadata tables as versioned Parquet folders; a pointer file names the current one.

    A new version is written beside the old and taken by replacing the pointer, so a
    plan may read the table it replaces and a failed write changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _current(self, table: str) -> str | None:
        fs, path = self._fs()
        pointer = path(f"{self.root}/{table}/_current")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, table: str) -> DataFrame:
        now = self._current(table)
        schema = T._parse_datatype_string(TABLES[table])
        if now is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/{now}")

    def write(self, table: str, df: DataFrame) -> None:
        fs, path = self._fs()
        old, version = self._current(table), f"v-{uuid.uuid4().hex}"
        names = [c.split()[0] for c in TABLES[table].split(", ")]
        types = {c.split()[0]: c.split()[1] for c in TABLES[table].split(", ")}
        df.select(*(F.col(n).cast(types[n]).alias(n) for n in names)).write.option("compression", "zstd").parquet(f"{self.root}/{table}/{version}")
        fresh = path(f"{self.root}/{table}/_next-{version}")
        stream = fs.create(fresh, True)
        stream.write(bytearray(version.encode()))
        stream.close()
        pointer = path(f"{self.root}/{table}/_current")
        if fs.exists(pointer):
            fs.delete(pointer, False)
        fs.rename(fresh, pointer)
        versions = [s for s in fs.listStatus(path(f"{self.root}/{table}")) if s.getPath().getName().startswith("v-")]
        for s in sorted(versions, key=lambda s: s.getModificationTime())[:-RETAIN]:
            if s.getPath().getName() not in (old, version):
                fs.delete(s.getPath(), True)

    def keys(self, table: str) -> list[str]:
        return KEYS[table]

