"""Remote archive store: listing and download. The HTTP client is injected."""

from __future__ import annotations

import os
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable
from datetime import date

from tidemark.functions.exprs import month_starts, normalize_symbol
from tidemark.schemas import SPECS
from tidemark.sources.paths import day_of_key

#: get(url_path, params, timeout) -> (status code, body)
Get = Callable[[str, dict, tuple[float, float]], tuple[int, bytes]]
PAGE_KEYS = 1000
RETRIES, BACKOFF_S, TIMEOUT = 6, 1.0, (10.0, 300.0)


def list_page(get: Get, prefix: str, delimiter: str = "/", max_keys: int = PAGE_KEYS) -> tuple[list[str], list[str]]:
    """Keys and common prefixes of one listing page."""
    status, body = get("", {"list-type": "2", "prefix": prefix, "delimiter": delimiter, "max-keys": str(max_keys)}, TIMEOUT)
    if status != 200:
        raise OSError(f"listing {prefix}: status {status}")
    found: dict[str, list[str]] = {"Key": [], "Prefix": []}
    tree = ET.fromstring(body)
    for node in tree.iter():
        name = node.tag.rsplit("}", 1)[-1]
        if name == "Contents":
            found["Key"] += [x.text or "" for x in node if x.tag.endswith("Key")]
        elif name == "CommonPrefixes":
            found["Prefix"] += [x.text or "" for x in node if x.tag.endswith("Prefix")]
    return found["Key"], found["Prefix"]


def list_month(get: Get, symbol: str, dataset: str, year: int, month: int, timeframe: str = "1m") -> list[str]:
    """Archives of a month; a month has fewer keys than a page."""
    spec, symbol = SPECS[dataset], normalize_symbol(symbol)
    stem = f"{symbol}/{timeframe}/{symbol}-{timeframe}" if spec.has_timeframe else f"{symbol}/{symbol}-fundingRates"
    keys, _ = list_page(get, f"data/futures/daily/{spec.remote_dir}/{stem}-{year:04d}-{month:02d}-")
    return [k for k in keys if k.endswith(".zip")]


def list_range(lister: Callable[..., list[str]], symbol: str, dataset: str, start: date, end: date, timeframe: str = "1m", on_error: Callable[[date, Exception], None] | None = None) -> list[str]:
    """Keys of the days from start to end, in order; a month that fails is reported and left out."""
    found: set[str] = set()
    for m in month_starts(start, end):
        try:
            found.update(lister(symbol, dataset, m.year, m.month, timeframe))
        except Exception as e:
            if on_error is None:
                raise
            on_error(m, e)
    return sorted(k for k in found if (d := day_of_key(k)) and start <= d <= end)


def download(get: Get, key: str, out_root: str, retries: int = RETRIES, backoff_s: float = BACKOFF_S, timeout: tuple[float, float] = TIMEOUT, sleep: Callable[[float], None] = time.sleep) -> str:
    """downloaded, exists, missing_remote, forbidden or client_error_N; other failures are tried again."""
    path = os.path.join(out_root, key)
    if os.path.exists(path):
        return "exists"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    last: Exception | None = None
    for attempt in range(1, retries + 1):
        try:
            status, body = get(key, {}, timeout)
        except OSError as e:
            last = e
        else:
            if status == 200:
                part = f"{path}.part"
                with open(part, "wb") as f:
                    f.write(body)
                os.replace(part, path)
                return "downloaded"
            if status == 404:
                return "missing_remote"
            if status in (401, 403):
                return "forbidden"
            if 400 <= status < 500 and status not in (408, 429):
                return f"client_error_{status}"
            last = OSError(f"status {status}")
        if attempt < retries:
            sleep(backoff_s * attempt)
    raise OSError(f"{key}: {last}")
