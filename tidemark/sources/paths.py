"""Paths of the lake: templates, and what a path says."""

from __future__ import annotations

from datetime import date

from tidemark.functions.exprs import normalize_symbol
from tidemark.schemas import DATASETS, MARKETS, SPECS


def leaf_dir(market: str, dataset: str, symbol: str, timeframe: str | None = None, day: date | None = None, month: str | None = None) -> str:
    """Relative folder of a partition: one-minute and funding rows by day, derived bars by month."""
    spec = SPECS[dataset]
    head = f"{market}/{dataset}/" + (f"timeframe={timeframe}/" if spec.has_timeframe else "") + f"symbol={symbol}/"
    return head + (f"month={month}" if spec.has_timeframe and timeframe != "1m" else f"date={day:%Y-%m-%d}")


def dataset_glob(root: str, market: str, dataset: str, timeframe: str = "*") -> str:
    base = f"{str(root).rstrip('/')}/{market}/{dataset}"
    if not SPECS[dataset].has_timeframe:
        return f"{base}/symbol=*/date=*/*.parquet"
    part = "*" if timeframe == "*" else "date=*" if timeframe == "1m" else "month=*"
    return f"{base}/timeframe={timeframe}/symbol=*/{part}/*.parquet"


def partitions_of(path: str) -> dict[str, str]:
    """Market, dataset and key=value folders named in a path."""
    found: dict[str, str] = {}
    for part in path.replace("\\", "/").split("/"):
        key, eq, value = part.partition("=")
        if eq and key in ("timeframe", "symbol", "date", "month"):
            found[key] = value
        elif part in MARKETS:
            found["market"] = part
        elif part in DATASETS:
            found["dataset"] = part
    return found


def archive_key(symbol: str, dataset: str, day: date, timeframe: str = "1m") -> str:
    spec, symbol = SPECS[dataset], normalize_symbol(symbol)
    head = f"data/futures/daily/{spec.remote_dir}/{symbol}"
    if spec.has_timeframe:
        return f"{head}/{timeframe}/{symbol}-{timeframe}-{day:%Y-%m-%d}.zip"
    return f"{head}/{symbol}-fundingRates-{day:%Y-%m-%d}.zip"


def day_of_key(key: str) -> date | None:
    """The day at the end of an archive's name."""
    stem = key.rsplit("/", 1)[-1].removesuffix(".zip")
    try:
        return date.fromisoformat(stem[-10:])
    except ValueError:
        return None
