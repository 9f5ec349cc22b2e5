"""Symbols picked from liquidity ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _positive(name: str, value: int | None) -> int | None:
    if value is not None and (isinstance(value, bool) or int(value) != value or value < 1):
        raise ValueError(f"{name} must be a positive integer")
    return value


def _series(liquidity: DataFrame, market: str, timeframe: str) -> DataFrame:
    return liquidity.where((F.col("market") == market) & (F.col("timeframe") == timeframe) & F.col("liquidity_rank_30d").isNotNull())


def _enough(rows: DataFrame, least: int | None) -> DataFrame:
    counted = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("days"))
    return counted.where(F.col("days") >= least) if least is not None else counted


def candidate_superset(liquidity: DataFrame, threshold: int, start=None, end=None, min_days: int | None = None, market: str = "futures", timeframe: str = "1m") -> DataFrame:
    """(symbol, days) of symbols ranked ``threshold`` or better on some, or ``min_days``, days of the window."""
    _positive("threshold", threshold), _positive("min_days", min_days)
    if start is not None and end is not None and str(start) > str(end):
        raise ValueError("start must not be after end")
    rows = _series(liquidity, market, timeframe).where(F.col("liquidity_rank_30d") <= threshold)
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("date") <= F.lit(end).cast("date"))
    return _enough(rows, min_days)


def near_threshold(liquidity: DataFrame, target: int, band: int, start=None, end=None, lookback: int = 14, min_days: int | None = None, market: str = "futures", timeframe: str = "1m") -> DataFrame:
    """(symbol, days) of symbols within ``band`` ranks of ``target``, by default in the latest ``lookback`` days."""
    _positive("target", target), _positive("lookback", lookback), _positive("min_days", min_days)
    rows = _series(liquidity, market, timeframe)
    if end is None:
        last = rows.agg(F.max("date").alias("_last"))
        rows = rows.join(F.broadcast(last), F.col("date") <= F.col("_last"))  # one row
    else:
        rows = rows.withColumn("_last", F.lit(end).cast("date")).where(F.col("date") <= F.col("_last"))
    first = F.date_sub("_last", lookback - 1) if start is None else F.lit(start).cast("date")
    rows = rows.where(F.col("date") >= first).where(F.col("liquidity_rank_30d").between(max(1, target - band), target + band))
    return _enough(rows, min_days)
