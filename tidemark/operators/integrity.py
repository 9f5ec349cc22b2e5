"""Minute-level integrity of one-minute bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.exprs import expected_rows


def integrity(bars: DataFrame, keys: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """Per key (a symbol's day): gaps, duplicates, bad prices, largest one-minute return.

    Returns never cross a key; a zero or null price before gives none. The window and
    the aggregate share one shuffle, on the key.
    """
    before = F.lag("close").over(Window.partitionBy(*keys).orderBy("ts", *(tiebreak or [])))
    rows = bars.withColumn("_ret", F.abs(F.try_divide(F.col("close"), before) - 1))
    minutes = F.countDistinct(F.date_trunc("minute", F.col("ts")))
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(
        n.alias("num_rows"),
        minutes.alias("distinct_minute_cnt"),
        (F.lit(expected_rows("1m")).cast("long") - minutes).alias("gap_rows_vs_expected"),
        (n - minutes).alias("duplicate_rows"),
        F.count_if(F.col("high") < F.col("low")).alias("high_lt_low_cnt"),
        F.count_if((F.col("open") <= 0) | (F.col("high") <= 0) | (F.col("low") <= 0) | (F.col("close") <= 0)).alias("nonpositive_price_cnt"),
        F.max("_ret").alias("max_abs_ret_1m"),
    )
