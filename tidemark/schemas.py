"""Schemas of lake datasets and metadata tables, with their keys."""

from __future__ import annotations

from dataclasses import dataclass

DATASETS = ("klines", "mark", "index", "funding")
CORE = ("klines", "mark", "index")
MARKETS = ("futures", "spot")


@dataclass(frozen=True)
class DatasetSpec:
    """Where a dataset's archives and files lie; funding has no timeframe."""

    name: str
    remote_dir: str
    has_timeframe: bool = True


SPECS = {
    "klines": DatasetSpec("klines", "klines"),
    "mark": DatasetSpec("mark", "mark"),
    "index": DatasetSpec("index", "index"),
    "funding": DatasetSpec("funding", "fundingRates", False),
}

_PRICES = "open double, high double, low double, close double"
RAW = {
    "klines": f"time_ms long, ts timestamp, {_PRICES}, volume double",
    "mark": f"time_ms long, ts timestamp, {_PRICES}",
    "index": f"time_ms long, ts timestamp, {_PRICES}",
    "funding": "symbol string, time_ms long, ts timestamp, funding_rate double",
}
DAILY = {
    "klines": f"date date, {_PRICES}, volume double, dollar_volume double, vwap double, src_rows long, min_ts timestamp, max_ts timestamp",
    "mark": f"date date, {_PRICES}, src_rows long, min_ts timestamp, max_ts timestamp",
    "index": f"date date, {_PRICES}, src_rows long, min_ts timestamp, max_ts timestamp",
}

_KEY = "market string, symbol string, date date, timeframe string"
TABLES = {
    "md_file_manifest": "file_rel string, market string, dataset string, file_path string, file_size_bytes long, mtime_ns long, first_seen_utc timestamp, last_seen_utc timestamp",
    "md_partition_coverage": "market string, dataset string, symbol string, date date, timeframe string, num_files long, num_rows long, distinct_minute_cnt long, min_ts timestamp, max_ts timestamp, expected_rows int, completeness_ratio double, is_suspect boolean, computed_at_utc timestamp",
    "md_kline_integrity_day": f"{_KEY}, num_rows long, distinct_minute_cnt long, gap_rows_vs_expected long, duplicate_rows long, high_lt_low_cnt long, nonpositive_price_cnt long, max_abs_ret_1m double, computed_at_utc timestamp",
    "md_symbol_dataset_stats": "market string, dataset string, symbol string, timeframe string, min_date date, max_date date, min_ts timestamp, max_ts timestamp, days_present long, days_complete long, pct_days_complete double, avg_rows_per_day double, last_refreshed_utc timestamp",
    "md_alignment_summary": f"{_KEY}, has_klines boolean, has_mark boolean, has_index boolean, has_funding boolean, all_core_present boolean, core_missing_mask string, core_completeness_min double, computed_at_utc timestamp",
    "md_liquidity_daily": f"{_KEY}, dollar_volume double, volume double, close_price double, dv_30d_median double, liquidity_rank_30d int, in_top_100 boolean, computed_at_utc timestamp",
}
_DAY = ["market", "symbol", "date", "timeframe"]
KEYS = {
    "md_file_manifest": ["file_rel"],
    "md_partition_coverage": ["market", "dataset", "symbol", "date", "timeframe"],
    "md_kline_integrity_day": _DAY,
    "md_symbol_dataset_stats": ["market", "dataset", "symbol", "timeframe"],
    "md_alignment_summary": _DAY,
    "md_liquidity_daily": _DAY,
}
#: Columns that say when a row was made, not what it holds.
STAMPS = ("computed_at_utc", "last_refreshed_utc", "first_seen_utc", "last_seen_utc")


def stable_columns(table: str) -> list[str]:
    names = [c.split()[0] for c in TABLES[table].split(", ")]
    return [n for n in names if n not in STAMPS]
