"""Violations that the validators look for, each a DataFrame of offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DAY = ["market", "symbol", "date"]


def ratio_out_of_bounds(covered: DataFrame) -> DataFrame:
    """Completeness that is negative, not the ratio of its counts, or there without expected rows."""
    r, e = F.col("completeness_ratio"), F.col("expected_rows")
    return covered.where((r < 0) | (r > 1) | (e.isNull() & r.isNotNull()))


def alignment_unbacked(aligned: DataFrame, covered: DataFrame) -> DataFrame:
    """Alignment rows without any coverage row; funding backs one-minute rows without a timeframe of its own."""
    c = covered.select(*_DAY, F.col("timeframe").alias("_tf"), "dataset")
    fits = (F.col("_tf") == F.col("timeframe")) | ((F.col("timeframe") == "1m") & (F.col("dataset") == "funding") & (F.col("_tf") == ""))
    on = [F.col(f"a.{k}") == F.col(f"c.{k}") for k in _DAY]
    return aligned.alias("a").join(c.alias("c"), [*on, fits], "left_anti")


def liquidity_unbacked(liquidity: DataFrame, covered: DataFrame) -> DataFrame:
    return liquidity.join(covered.where("dataset = 'klines'"), [*_DAY, "timeframe"], "left_anti")


def not_one_minute(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("timeframe").eqNullSafe(F.lit("1m")))


def misplaced_funding(covered: DataFrame) -> DataFrame:
    """Funding in builds of another timeframe."""
    return covered.where("dataset = 'funding' and timeframe not in ('', '1m')")
