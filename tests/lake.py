"""Small lakes for tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pandas as pd


def minutes(day: date, n: int = 1440, price: float = 1.0, volume: float = 1.0) -> pd.DataFrame:
    ts = [datetime(day.year, day.month, day.day) + timedelta(minutes=i) for i in range(n)]
    df = pd.DataFrame({"time_ms": [int(t.timestamp() * 1000) for t in ts], "ts": pd.to_datetime(ts).astype("datetime64[us]").tz_localize("UTC")})
    for c in ("open", "high", "low", "close"):
        df[c] = price
    df["volume"] = volume
    return df


def put(root, df: pd.DataFrame, dataset: str, symbol: str, day: date, timeframe: str | None = "1m") -> Path:
    base = Path(root) / "futures" / dataset
    if timeframe:
        base = base / f"timeframe={timeframe}"
    folder = base / f"symbol={symbol}" / (f"date={day}" if timeframe in (None, "1m") else f"month={day:%Y-%m}")
    folder.mkdir(parents=True, exist_ok=True)
    df.to_parquet(folder / "data.parquet", index=False)
    return folder / "data.parquet"


def one_row_days(root, symbol: str, start: date, n: int) -> None:
    """A one-row file to a day; dollar volume is 1, 2, 3, ..."""
    for i in range(n):
        d = start + timedelta(days=i)
        put(root, minutes(d, 1, volume=float(i + 1)), "klines", symbol, d)
