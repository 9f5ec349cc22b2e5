"""Raw rows as archives hold them, made into typed bars; and what to download."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import epoch_ms


def normalize_bars(raw: DataFrame, volume: bool = True) -> DataFrame:
    """time_ms, ts and double prices from text columns (time, open, high, low, close[, volume])."""
    ms = epoch_ms(F.col("time"))
    names = ["open", "high", "low", "close", *(["volume"] if volume else [])]
    extra = [c for c in raw.columns if c not in ("time", *names)]
    return raw.select(*extra, ms.alias("time_ms"), F.timestamp_millis(ms).alias("ts"), *(F.col(n).cast("double").alias(n) for n in names))


def normalize_funding(raw: DataFrame) -> DataFrame:
    ms = epoch_ms(F.col("time"))
    extra = [c for c in raw.columns if c not in ("symbol", "time", "fundingRate")]
    return raw.select(*extra, "symbol", ms.alias("time_ms"), F.timestamp_millis(ms).alias("ts"), F.col("fundingRate").cast("double").alias("funding_rate"))


def download_plan(requested: DataFrame, listed: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """Requested keys that are listed and not there yet."""
    return requested.join(listed.select(*keys).distinct(), keys, "left_semi").join(local.select(*keys).distinct(), keys, "left_anti")


def changed_files(now: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are new, or whose size or modification time is another than the manifest's."""
    k = known.select("file_rel", F.col("file_size_bytes").alias("_size"), F.col("mtime_ns").alias("_mtime"))
    joined = now.join(k, "file_rel", "left")
    return joined.where(F.col("_size").isNull() | (F.col("file_size_bytes") != F.col("_size")) | (F.col("mtime_ns") != F.col("_mtime"))).drop("_size", "_mtime")
