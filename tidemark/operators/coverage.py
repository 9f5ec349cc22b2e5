"""Coverage of partitions, statistics of symbols, alignment of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import expected_rows, funding_scope, names_where
from tidemark.schemas import CORE


def coverage(rows: DataFrame, keys: list[str], timeframe: str | None, threshold: float = 0.98, file: Column | str = "file", first: str = "ts", last: str = "ts") -> DataFrame:
    """Per key: files, rows, exact distinct minutes, time range, completeness against a full day.

    With no ``timeframe``, as for funding, expected rows and what follows from them are null.
    Distinct files and minutes are sets of a key, which has a day's minutes at most, so that
    rows combine before the one shuffle and none is expanded.
    """
    expected = expected_rows(timeframe) if timeframe else None
    out = rows.groupBy(*keys).agg(
        F.size(F.collect_set(file)).cast("long").alias("num_files"),
        F.count(F.lit(1)).alias("num_rows"),
        F.size(F.collect_set(F.date_trunc("minute", F.col(first)))).cast("long").alias("distinct_minute_cnt"),
        F.min(first).alias("min_ts"),
        F.max(last).alias("max_ts"),
    )
    e = F.lit(expected).cast("int")
    return out.withColumn("expected_rows", e).withColumn("completeness_ratio", F.col("num_rows") / e).withColumn("is_suspect", F.col("completeness_ratio") < threshold)


def merge_partial(parts: DataFrame, keys: list[str], threshold: float = 0.98) -> DataFrame:
    """Coverage of keys whose rows were counted in several parts without shared minutes."""
    out = parts.groupBy(*keys).agg(
        *(F.sum(c).cast("long").alias(c) for c in ("num_files", "num_rows", "distinct_minute_cnt")), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"), F.max("expected_rows").alias("expected_rows")
    )
    return out.withColumn("completeness_ratio", F.col("num_rows") / F.col("expected_rows")).withColumn("is_suspect", F.col("completeness_ratio") < threshold)


def _timeframe(timeframe: str) -> Column:
    return F.when((F.col("dataset") == "funding") & (F.col("timeframe") == ""), F.lit("1m")).otherwise(F.col("timeframe"))


def symbol_stats(covered: DataFrame, timeframe: str) -> DataFrame:
    """Per (market, dataset, symbol, timeframe): ranges, days present and complete.

    Days whose completeness is unknown count as complete, but not in the share of complete days.
    """
    rows = covered.where(funding_scope(timeframe)).withColumn("timeframe", _timeframe(timeframe))
    return rows.groupBy("market", "dataset", "symbol", "timeframe").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.count(F.lit(1)).alias("days_present"),
        F.count(F.when(~F.coalesce("is_suspect", F.lit(False)), 1)).alias("days_complete"),
        F.avg(F.when(F.col("is_suspect").isNotNull(), (~F.col("is_suspect")).cast("double"))).alias("pct_days_complete"),
        F.avg("num_rows").alias("avg_rows_per_day"),
    )


def alignment(covered: DataFrame, timeframe: str) -> DataFrame:
    """Per (market, symbol, date, timeframe): which datasets are there, which core ones are not."""
    rows = covered.where(funding_scope(timeframe)).withColumn("timeframe", _timeframe(timeframe))
    there = {d: F.max(F.col("dataset") == d) for d in (*CORE, "funding")}
    out = rows.groupBy("market", "symbol", "date", "timeframe").agg(
        *(flag.alias(f"has_{d}") for d, flag in there.items()), F.min(F.when(F.col("dataset").isin(*CORE), F.col("completeness_ratio"))).alias("core_completeness_min")
    )
    has = {d: F.col(f"has_{d}") for d in CORE}
    return out.withColumn("all_core_present", has["klines"] & has["mark"] & has["index"]).withColumn("core_missing_mask", names_where({d: ~flag for d, flag in has.items()}))


def missing_keys(covered: DataFrame, target: DataFrame, timeframe: str) -> DataFrame:
    """(market, symbol, date, timeframe) that kline coverage has and ``target`` has not."""
    keys = ["market", "symbol", "date", "timeframe"]
    return covered.where((F.col("dataset") == "klines") & (F.col("timeframe") == timeframe)).select(*keys).join(target, keys, "left_anti")
