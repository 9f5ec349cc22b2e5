"""Daily liquidity: dollar volume, 30-row rolling median, cross-sectional rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import last_by

SERIES = ["market", "timeframe", "symbol"]
LOOKBACK, TOP = 30, 100


def daily_base(bars: DataFrame, keys: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    return bars.groupBy(*keys).agg(
        F.sum(F.col("close") * F.col("volume")).alias("dollar_volume"), F.sum("volume").alias("volume"), last_by("close", "ts", *(tiebreak or [])).alias("close_price")
    )


def with_median(base: DataFrame, lookback: int = LOOKBACK, digits: int | None = None) -> DataFrame:
    """Median of the last ``lookback`` rows of a series, its first rows included as they are."""
    window = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(1 - lookback, 0)
    median: Column = F.percentile("dollar_volume", 0.5).over(window)
    return base.withColumn("dv_30d_median", median if digits is None else F.round(median, digits))


def with_rank(rows: DataFrame, top: int = TOP) -> DataFrame:
    """Rank by median within a market's day, ties shared, nulls last."""
    day = Window.partitionBy("market", "timeframe", "date").orderBy(F.desc_nulls_last("dv_30d_median"))
    ranked = rows.withColumn("liquidity_rank_30d", F.rank().over(day).cast("int"))
    return ranked.withColumn("in_top_100", F.col("liquidity_rank_30d") <= top)


def rolling_rank(base: DataFrame, lookback: int = LOOKBACK, top: int = TOP, digits: int | None = None) -> DataFrame:
    return with_rank(with_median(base, lookback, digits), top)


def rolling_rank_in_range(base: DataFrame, start, end, lookback: int = LOOKBACK, top: int = TOP) -> DataFrame:
    """rolling_rank of the days from ``start`` to ``end``.

    Of each series the ``lookback`` - 1 rows before the range are read too, however many
    days back they lie, so the result is that of a full build.
    """
    rows = base.where(F.col("date") <= F.lit(end))
    back = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    early = rows.where(F.col("date") < F.lit(start)).withColumn("_n", F.row_number().over(back)).where(F.col("_n") < lookback).drop("_n")
    joined = early.unionByName(rows.where(F.col("date") >= F.lit(start)))
    return with_rank(with_median(joined, lookback).where(F.col("date") >= F.lit(start)), top)


def rolling_rank_for_keys(base: DataFrame, keys: DataFrame, lookback: int = LOOKBACK, top: int = TOP) -> DataFrame:
    """rolling_rank of all symbols on the dates of ``keys``: a new symbol shifts the ranks of its peers.

    Medians are taken over the rows of those dates and the ``lookback`` - 1 before them in each
    series only.
    """
    dates = keys.select("market", "timeframe", "date").distinct().withColumn("_due", F.lit(True))
    flagged = base.join(dates, ["market", "timeframe", "date"], "left")
    ahead = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(0, lookback - 1)
    needed = flagged.withColumn("_near", F.max("_due").over(ahead)).where("_near").drop("_near")
    return with_rank(with_median(needed, lookback).where("_due").drop("_due"), top)
