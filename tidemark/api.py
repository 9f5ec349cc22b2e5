"""What the package offers, in one place."""

from tidemark.plans.fetch import fetch_futures
from tidemark.plans.ingest import ingest_local_downloads_to_lake
from tidemark.plans.metadata import backfill_derived_from_coverage, build_kline_integrity, build_metadata
from tidemark.plans.resample import resample_bars as resample_1m_to_1d
from tidemark.plans.research import build_base_panel, build_universe_daily
from tidemark.plans.validate import validate, validate_all
from tidemark.operators.panel import panel_summary as summarize_panel
from tidemark.operators.universe import turnover as summarize_universe

__all__ = [
    "backfill_derived_from_coverage", "build_base_panel", "build_kline_integrity", "build_metadata", "build_universe_daily", "fetch_futures",
    "ingest_local_downloads_to_lake", "resample_1m_to_1d", "summarize_panel", "summarize_universe", "validate", "validate_all",
]
