"""Returns panel: exact-calendar-day returns joined to the universe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.tables import first_rows, require_unique

HORIZONS = (1, 5, 20)
COLUMNS = [
    "day", "symbol", "asof_date", "is_weekend", "asof_dv_30d_median", "asof_liquidity_rank_30d", "asof_dollar_volume", "asof_volume", "asof_close_price",
    "open", "high", "low", "close", "volume", "dollar_volume", "log_dollar_volume", "vwap", "src_rows", "max_ts",
    "ret_1d", "fwd_ret_1d", "fwd_ret_5d", "fwd_ret_20d", "log_ret_1d", "fwd_log_ret_1d",
]
_BARS = ["open", "high", "low", "close", "volume", "dollar_volume", "vwap", "src_rows", "max_ts"]


def exact_day_returns(bars: DataFrame, check: bool = True) -> DataFrame:
    """Adds returns to the closes exactly one day back and 1, 5, 20 days ahead; null where a day is missing.

    The closes are looked up in range frames over the day's number, all on one shuffle by
    symbol, and rely on one row for each (symbol, day), which ``check`` looks into first.
    """
    if check:
        require_unique(bars, ["symbol", "day"])
    return _returns(bars, False)


def _returns(bars: DataFrame, guard: bool) -> DataFrame:
    """With ``guard`` a repeated (symbol, day) fails where it is met, without a pass of its own."""
    numbered = bars.withColumn("_n", F.unix_date("day"))

    def near(k: int) -> Window:
        return Window.partitionBy("symbol").orderBy("_n").rangeBetween(k, k)

    def close_at(k: int) -> Column:
        return F.max("close").over(near(k))

    def log_ratio(a: Column, b: Column) -> Column:
        return F.when((a > 0) & (b > 0), F.ln(a) - F.ln(b))

    numbered = numbered.withColumn("_m1", close_at(-1))
    for k in HORIZONS:
        numbered = numbered.withColumn(f"_p{k}", close_at(k))
    if guard:
        twice = F.raise_error(F.concat(F.lit("not unique by ['symbol', 'day']: "), F.col("symbol"), F.lit(" "), F.col("day").cast("string"))).cast("double")
        numbered = numbered.withColumn("_own", F.count(F.lit(1)).over(near(0))).withColumn("_m1", F.when(F.col("_own") > 1, twice).otherwise(F.col("_m1"))).drop("_own")
    close = F.col("close")
    out = numbered.withColumn("ret_1d", F.try_divide(close, F.col("_m1")) - 1)
    for k in HORIZONS:
        out = out.withColumn(f"fwd_ret_{k}d", F.try_divide(F.col(f"_p{k}"), close) - 1)
    out = out.withColumn("log_ret_1d", log_ratio(close, F.col("_m1"))).withColumn("fwd_log_ret_1d", log_ratio(F.col("_p1"), close))
    return out.drop("_n", "_m1", *(f"_p{k}" for k in HORIZONS))


def base_panel(universe: DataFrame, bars: DataFrame, start=None, end=None, members_only: bool = True, check: bool = True) -> DataFrame:
    """Universe rows with the bars and returns of their day.

    ``bars``: (symbol, day, ...) of daily bars. Returns use the whole bar series, within the
    days asked for plus one before and twenty after. Neither the universe nor the bars are
    read a second time; with ``check`` a repeated (symbol, day) of bars fails the query.
    """
    rows = universe.where("in_universe") if members_only and "in_universe" in universe.columns else universe
    if start is not None:
        rows = rows.where(F.col("day") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("day") <= F.lit(end))
    extra = [c for c in ("entry_n", "exit_n") if c in universe.columns]
    kept = [c for c in COLUMNS if c in universe.columns and c not in _BARS]
    rows = first_rows(rows.select(*kept, *extra), ["day", "symbol"])
    near = bars.select("symbol", "day", *_BARS)
    if start is not None:
        near = near.where(F.col("day") >= F.date_sub(F.lit(start).cast("date"), 1))
    if end is not None:
        near = near.where(F.col("day") <= F.date_add(F.lit(end).cast("date"), max(HORIZONS)))
    returned = _returns(near, check)
    dollars = F.when(F.col("dollar_volume").isNotNull(), F.ln(F.greatest("dollar_volume", F.lit(1.0))))
    return rows.join(returned, ["day", "symbol"], "left").withColumn("log_dollar_volume", dollars).select(*(c for c in COLUMNS), *extra)


def panel_summary(panel: DataFrame) -> DataFrame:
    missing = lambda c: F.avg(F.col(c).isNull().cast("double"))
    return panel.groupBy("day").agg(
        F.countDistinct("symbol").alias("n_symbols"),
        *(F.avg(c).alias(f"mean_{c}") for c in ("ret_1d", "fwd_ret_1d", "fwd_ret_5d", "fwd_ret_20d")),
        missing("close").alias("missing_close_pct"),
        missing("fwd_ret_1d").alias("missing_fwd_ret_1d_pct"),
    )
