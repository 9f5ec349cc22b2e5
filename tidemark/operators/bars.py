"""Daily bars from finer ones, and the plan of what to resample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import first_by, last_by, vwap


def daily_bars(bars: DataFrame, keys: list[str], tiebreak: list[str] | None = None, volume: bool = True, in_order: bool | list[str] = False) -> DataFrame:
    """One row per key: open, high, low, close, [volume, dollar_volume, vwap,] src_rows, min_ts, max_ts.

    Rows are ordered by ts, then ``tiebreak``. One shuffle, combined before it. Sums of doubles
    depend in their last bit on how rows are dealt out; with ``in_order`` they add a key's rows
    one after the other, whatever their partitions, which shuffles and sorts all rows:
    in the same order, or by the columns given.
    """
    order = ["ts", *(tiebreak or [])]
    aggs = [first_by("open", *order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last_by("close", *order).alias("close")]
    if volume and in_order:
        added = in_order if isinstance(in_order, list) else order
        so_far = Window.partitionBy(*keys).orderBy(*added).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bars = bars.withColumns({"_volume": F.sum("volume").over(so_far), "_dollars": F.sum(F.col("close") * F.col("volume")).over(so_far)})
        total, dollars = last_by("_volume", *added), last_by("_dollars", *added)
        aggs += [total.alias("volume"), dollars.alias("dollar_volume"), F.when(total != 0, dollars / total).alias("vwap")]
    elif volume:
        aggs += [F.sum("volume").alias("volume"), F.sum(F.col("close") * F.col("volume")).alias("dollar_volume"), vwap().alias("vwap")]
    aggs += [F.count(F.lit(1)).alias("src_rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")]
    return bars.groupBy(*keys).agg(*aggs)


def months_to_resample(partitions: DataFrame, symbols: list[str] | None = None, months: list[str] | None = None, max_tasks: int | None = None) -> DataFrame:
    """Distinct (symbol, month) of (symbol, date) partitions, in order where a limit asks for it."""
    tasks = partitions.select("symbol", F.date_format("date", "yyyy-MM").alias("month")).distinct()
    if symbols:
        tasks = tasks.where(F.col("symbol").isin(symbols))
    if months:
        tasks = tasks.where(F.col("month").isin(months))
    return tasks.orderBy("symbol", "month").limit(max_tasks) if max_tasks is not None else tasks
