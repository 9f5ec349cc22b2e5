"""Minute bars of a stream of ticks, closed by a watermark.

The batch tables are refreshed incrementally; this is the same first step for
ticks that arrive continuously. Late ticks beyond the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import first_by, last_by


def minute_bars(ticks: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """(symbol, ts, open, high, low, close, volume) from (symbol, ts, price, volume), batch or stream."""
    rows = ticks.withWatermark("ts", lateness) if ticks.isStreaming else ticks
    bars = rows.groupBy("symbol", F.window("ts", "1 minute").alias("w")).agg(
        first_by("price", "ts").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), last_by("price", "ts").alias("close"), F.sum("volume").alias("volume")
    )
    return bars.select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")
