"""Point-in-time universe: ranks of the day before, hysteresis, turnover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ENTRY, EXIT = 100, 130
ASOF = {
    "dv_30d_median": "asof_dv_30d_median",
    "liquidity_rank_30d": "asof_liquidity_rank_30d",
    "dollar_volume": "asof_dollar_volume",
    "volume": "asof_volume",
    "close_price": "asof_close_price",
}
COLUMNS = ["day", "symbol", "asof_date", *ASOF.values(), "entry_n", "exit_n", "is_weekend"]


def candidate_ranks(liquidity: DataFrame, start, end, market: str = "futures", timeframe: str = "1m") -> DataFrame:
    """Candidates of each day from ``start`` to ``end``: a row serves the day after its date, and no other."""
    rows = liquidity.where((F.col("market") == market) & (F.col("timeframe") == timeframe)).where(F.col("date").between(F.date_sub(F.lit(start).cast("date"), 1), F.date_sub(F.lit(end).cast("date"), 1)))
    return rows.select(F.date_add("date", 1).alias("day"), F.col("date").alias("asof_date"), "symbol", *(F.col(a).alias(b) for a, b in ASOF.items()))


def with_state(candidates: DataFrame, entry_n: int = ENTRY, exit_n: int = EXIT) -> DataFrame:
    """All candidates with ``in_universe``: in from rank ``entry_n``, out behind rank ``exit_n`` or when absent.

    A fold over days in closed form: within a run of days that a symbol does not miss,
    the last decisive rank holds. Days are counted over those that have candidates.
    """
    if not 0 < entry_n <= exit_n:
        raise ValueError("entry_n must be positive and at most exit_n")
    # one row per day: the only window without partitions is over the calendar
    days = candidates.select("day").distinct().withColumn("_i", F.row_number().over(Window.orderBy("day")))
    rank = F.col("asof_liquidity_rank_30d")
    rows = candidates.join(days, "day").withColumn("_sig", F.when(rank <= entry_n, True).when(rank > exit_n, False))
    rows = rows.withColumn("_run", F.col("_i") - F.row_number().over(Window.partitionBy("symbol").orderBy("_i")))
    state = F.last("_sig", ignorenulls=True).over(Window.partitionBy("symbol", "_run").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(*candidates.columns, F.coalesce(state, F.lit(False)).alias("in_universe"), F.lit(entry_n).alias("entry_n"), F.lit(exit_n).alias("exit_n"), (F.weekday("day") >= 5).alias("is_weekend"))


def hysteresis(candidates: DataFrame, entry_n: int = ENTRY, exit_n: int = EXIT) -> DataFrame:
    """Members of each day."""
    return with_state(candidates, entry_n, exit_n).where("in_universe").drop("in_universe")


def universe_daily(liquidity: DataFrame, start, end, entry_n: int = ENTRY, exit_n: int = EXIT, market: str = "futures", timeframe: str = "1m", all_candidates: bool = False) -> DataFrame:
    """Members with their as-of values; with ``all_candidates`` every candidate and ``in_universe``."""
    candidates = candidate_ranks(liquidity, start, end, market, timeframe)
    if not all_candidates:
        return hysteresis(candidates, entry_n, exit_n).select(*COLUMNS)
    return with_state(candidates, entry_n, exit_n).select(*COLUMNS, "in_universe")


def turnover(universe: DataFrame) -> DataFrame:
    """Per day with members: members, adds, drops and rate against the day with members before it."""
    flagged = "in_universe" in universe.columns
    members = (universe.where("in_universe") if flagged else universe).select("day", "symbol").distinct()
    counts = members.groupBy("day").agg(F.count(F.lit(1)).alias("n_members"))
    order = Window.orderBy("day")
    counts = counts.select("day", "n_members", F.row_number().over(order).alias("_j"), F.lag("n_members").over(order).alias("_before"))
    # a symbol is new on a day unless its own day before is the one before overall
    own = F.lag("_j").over(Window.partitionBy("symbol").orderBy("_j"))
    new = members.join(counts.select("day", "_j"), "day").withColumn("_new", F.coalesce(own != F.col("_j") - 1, F.lit(True)))
    adds = new.groupBy("day").agg(F.count_if("_new").alias("adds"))
    out = counts.join(adds, "day").withColumn("drops", F.coalesce(F.col("_before") - F.col("n_members") + F.col("adds"), F.lit(0)))
    out = out.withColumn("turnover_rate", F.when(F.col("_before").isNull(), 0.0).otherwise((F.col("adds") + F.col("drops")) / F.col("_before")))
    if flagged:
        out = out.join(universe.groupBy("day").agg(F.count(F.lit(1)).alias("candidate_count")), "day", "left")
    else:
        out = out.withColumn("candidate_count", F.lit(None).cast("long"))
    return out.select("day", "n_members", "adds", "drops", "turnover_rate", "candidate_count")
