"""Local archives into the lake."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, normalize_symbol
from tidemark.operators.archives import normalize_bars, normalize_funding
from tidemark.schemas import DATASETS, RAW, SPECS
from tidemark.sources.archives import INVALID, download_root, in_flight, list_archives, read_archives
from tidemark.sources.lake import Scope, exists, read_dataset, write_partitioned
from tidemark.sources.paths import leaf_dir


def log_error(path: str, entry: dict) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a") as f:
        f.write(json.dumps({"at": datetime.now(timezone.utc).isoformat(), **entry}, default=str) + "\n")


def _present(spark: SparkSession, root: str, dataset: str, timeframe: str, market: str, listed: list[tuple[str, str, str]], start, end, how: str) -> set[tuple[str, str]]:
    """(symbol, day) of archives whose partition is there."""
    if how == "targets":
        tf = timeframe if SPECS[dataset].has_timeframe else None
        keys = {(normalize_symbol(s), d) for _, s, d in listed}
        return {(s, d) for s, d in keys if exists(spark, f"{root.rstrip('/')}/{leaf_dir(market, dataset, s, tf, as_date(d))}")}
    there = read_dataset(spark, root, dataset, timeframe, market, Scope(None, start, end))
    # a row for each folder in the window
    return set() if there is None else {tuple(r) for r in there.select("symbol", "date").distinct().collect()}


def ingest_local_downloads_to_lake(spark: SparkSession, downloads: str, root: str, *, start_date, end_date, datasets=DATASETS, symbols=None, timeframe: str = "1m", market: str = "futures", overwrite: bool = False, check_zips: bool = True, error_log: str | None = None, done: str = "scan") -> dict:
    """Write the archives of a window as partitions; those already there are skipped unless ``overwrite``.

    ``done`` says how they are found: ``scan`` lists the lake's partitions of the window,
    ``targets`` looks up the folder of each archive, ``skip`` looks for none.
    Archives are checked where they are read, on the executors.
    Counts by dataset: found, in_flight, invalid, skipped, done, failed.
    """
    if done not in ("scan", "targets", "skip"):
        raise ValueError("done must be scan, targets or skip")
    start, end = as_date(start_date, "start_date"), as_date(end_date, "end_date")
    if start is None or end is None or start > end:
        raise ValueError("start_date and end_date must be given, in order")
    source, scope, out = download_root(downloads), Scope(tuple(symbols) if symbols else None, start, end), {}
    error_log = error_log or os.path.join(root, "_errors.jsonl")
    for dataset in datasets:
        tf = timeframe if SPECS[dataset].has_timeframe else None
        listed = list_archives(source, dataset, scope, timeframe)
        counts = {"found": len(listed), "in_flight": 0, "invalid": 0, "skipped": 0, "done": 0, "failed": 0}
        out[dataset] = counts
        present = set() if overwrite or not listed or done == "skip" else _present(spark, root, dataset, timeframe, market, listed, start, end, done)
        ready = []
        for path, symbol, day in listed:
            if (normalize_symbol(symbol), day) in present:
                counts["skipped"] += 1
            elif in_flight(path):
                counts["in_flight"] += 1
            else:
                ready.append((path, normalize_symbol(symbol), day))
        if not ready:
            continue
        raw = read_archives(spark, ready, dataset, check_zips).cache()
        failed = raw.where("error is not null").select("path", "error").distinct().collect()  # one for each archive
        for r in failed:
            log_error(error_log, {"dataset": dataset, "path": r.path, "error": r.error})
        rows = raw.where("error is null").drop("path", "error")
        rows = normalize_funding(rows) if dataset == "funding" else normalize_bars(rows, volume=dataset == "klines")
        names = [c.split()[0] for c in RAW[dataset].split(", ") if not c.startswith("symbol ")]
        rows = rows.select(*names, F.lit(tf or "").alias("timeframe"), F.col("lake_symbol").alias("symbol"), F.col("lake_date").alias("date"))
        write_partitioned(rows, root, dataset, market)
        raw.unpersist()
        counts["invalid"] = sum(r.error.startswith(INVALID) for r in failed)
        counts["failed"] = len(failed) - counts["invalid"]
        counts["done"] = len(ready) - len(failed)
    return {"ok": not any(c["failed"] or c["invalid"] for c in out.values()), "datasets": out}
