"""Daily bars written to the lake, for whole months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.metadata import BROADCAST_KEYS
from tidemark.operators.bars import daily_bars, months_to_resample
from tidemark.schemas import DAILY
from tidemark.sources.lake import Scope, read_dataset, write_partitioned
from tidemark.sources.paths import partitions_of


def _from_changed(spark: SparkSession, changed: list[str], dataset: str, market: str, timeframe: str) -> DataFrame:
    rows = set()
    for path in changed:
        p = partitions_of(path)
        if p.get("dataset") == dataset and p.get("market") == market and p.get("timeframe") == timeframe and "date" in p and "symbol" in p:
            rows.add((p["symbol"], p["date"]))
    return spark.createDataFrame(sorted(rows), "symbol string, date string")


def plan(spark: SparkSession, root: str, *, dataset: str = "klines", market: str = "futures", timeframe_src: str = "1m", timeframe_dst: str = "1d", changed_files=None, symbols=None, months=None, max_tasks: int | None = None, overwrite: bool = True) -> DataFrame | None:
    """(symbol, month) to make: of changed files, or of all there are; without ``overwrite`` those not there yet."""
    if changed_files is not None:
        parts = _from_changed(spark, list(changed_files), dataset, market, timeframe_src)
    else:
        rows = read_dataset(spark, root, dataset, timeframe_src, market)
        if rows is None:
            return None
        parts = rows.select("symbol", "date")
    tasks = months_to_resample(parts, symbols, months)
    if not overwrite:
        there = read_dataset(spark, root, dataset, timeframe_dst, market)
        if there is not None:
            tasks = tasks.join(there.select("symbol", "month").distinct(), ["symbol", "month"], "left_anti")
    return tasks.orderBy("symbol", "month").limit(max_tasks) if max_tasks is not None else tasks


def resample_bars(spark: SparkSession, root: str, *, dataset: str = "klines", market: str = "futures", timeframe_src: str = "1m", timeframe_dst: str = "1d", changed_files=None, symbols=None, months=None, max_tasks: int | None = None, overwrite: bool = True, plan_only: bool = False) -> dict:
    """Daily bars of all planned months in one job. The day is the folder's, not the time's."""
    if dataset not in DAILY:
        raise ValueError(f"{dataset} has no bars")
    if (timeframe_src, timeframe_dst) != ("1m", "1d"):
        raise ValueError("only 1m to 1d is defined")
    tasks = plan(spark, root, dataset=dataset, market=market, timeframe_src=timeframe_src, timeframe_dst=timeframe_dst, changed_files=changed_files, symbols=symbols, months=months, max_tasks=max_tasks, overwrite=overwrite)
    listed = [] if tasks is None else [tuple(r) for r in tasks.orderBy("symbol", "month").collect()]
    out = {"ok": True, "planned": len(listed), "tasks": [{"symbol": s, "month": m, "status": "planned"} for s, m in listed], "errors": []}
    if plan_only or not listed:
        return out
    scope = Scope(tuple(sorted({s for s, _ in listed})))
    rows = read_dataset(spark, root, dataset, timeframe_src, market, scope).withColumn("month", F.substring("date", 1, 7))
    rows = rows.where(F.col("month").isin(sorted({m for _, m in listed})))
    wanted = spark.createDataFrame(listed, "symbol string, month string")
    rows = rows.join(F.broadcast(wanted) if len(listed) <= BROADCAST_KEYS else wanted, ["symbol", "month"], "left_semi")
    bars = daily_bars(rows.withColumn("date", F.to_date("date")), ["symbol", "month", "date"], volume=dataset == "klines")
    names = [c.split()[0] for c in DAILY[dataset].split(", ")]
    try:
        write_partitioned(bars.select(*names, F.lit(timeframe_dst).alias("timeframe"), "symbol", "month"), root, dataset, market)
        for t in out["tasks"]:
            t["status"] = "done"
    except Exception as e:
        out |= {"ok": False, "errors": [f"{type(e).__name__}: {e}"]}
        for t in out["tasks"]:
            t["status"] = "error"
    return out
