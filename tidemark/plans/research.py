"""Universe and panel built from stored tables and written as Parquet."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date
from tidemark.operators.panel import base_panel
from tidemark.operators.universe import ENTRY, EXIT, universe_daily
from tidemark.sources.lake import MetaStore, read_dataset


def build_universe_daily(spark: SparkSession, meta_root: str, *, start_date, end_date, out: str | None = None, entry_n: int = ENTRY, exit_n: int = EXIT, market: str = "futures", timeframe: str = "1m", include_all_candidates: bool = False) -> DataFrame:
    start, end = as_date(start_date, "start_date"), as_date(end_date, "end_date")
    if start > end:
        raise ValueError("start_date must be <= end_date")
    df = universe_daily(MetaStore(spark, meta_root).read("md_liquidity_daily"), start, end, entry_n, exit_n, market, timeframe, include_all_candidates)
    if out is None:
        return df
    df.write.mode("overwrite").parquet(out)
    about = {"start_date": str(start), "end_date": str(end), "entry_n": entry_n, "exit_n": exit_n, "market": market, "timeframe": timeframe, "include_all_candidates": include_all_candidates, "created_utc": datetime.now(timezone.utc).isoformat()}
    with open(out.rstrip("/").removesuffix(".parquet") + ".meta.json", "w") as f:
        json.dump(about, f, indent=2, sort_keys=True)
    return spark.read.parquet(out)


def build_base_panel(spark: SparkSession, root: str, universe: str | DataFrame, *, out: str | None = None, overwrite: bool = False, start_date=None, end_date=None, members_only: bool = True, market: str = "futures") -> DataFrame:
    if out and not overwrite and os.path.exists(out):
        raise FileExistsError(out)
    rows = spark.read.parquet(universe) if isinstance(universe, str) else universe
    bars = read_dataset(spark, root, "klines", "1d", market)
    if bars is None:
        raise FileNotFoundError(f"no daily klines under {root}")
    bars = bars.withColumn("day", F.to_date("date")).withColumn("max_ts", F.col("max_ts").cast("timestamp"))
    df = base_panel(rows, bars, as_date(start_date), as_date(end_date), members_only)
    if out is None:
        return df
    df.write.mode("overwrite" if overwrite else "error").parquet(out)
    return spark.read.parquet(out)
