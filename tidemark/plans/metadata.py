"""Building metadata tables from the lake, in full or for what has changed.

Every table is computed as a DataFrame for the affected keys and merged into its
current version. The manifest is written last: a run that fails is repeated.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, resolve
from tidemark.operators import coverage as cov
from tidemark.operators import liquidity as liq
from tidemark.operators.archives import changed_files
from tidemark.operators.integrity import integrity
from tidemark.operators.tables import replace_where, union_by_name, upsert
from tidemark.schemas import DATASETS, SPECS
from tidemark.sources.lake import MetaStore, Scope, day_column, read_dataset
from tidemark.sources.manifest import merged_manifest, scan_files
from tidemark.sources.paths import partitions_of

KEY = ["market", "symbol", "date", "timeframe"]
#: Partition keys of that many rows at most are broadcast to prune a scan.
BROADCAST_KEYS = 200_000


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def scope_of(symbols=None, date_start=None, date_end=None) -> Scope:
    start, end = as_date(date_start, "date_start"), as_date(date_end, "date_end")
    if start and end and start > end:
        raise ValueError("date_start must be <= date_end")
    return Scope(tuple(sorted(set(symbols))) if symbols else None, start, end)


def _stamp(df: DataFrame, at: datetime, name: str = "computed_at_utc") -> DataFrame:
    return df.withColumn(name, F.lit(at).cast("timestamp"))


def _only(df: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``names`` are among ``keys``."""
    keys = keys.select(*names).distinct()
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if small else keys, names, "left_semi")


def _klines(spark: SparkSession, root: str, market: str, timeframe: str, scope: Scope) -> DataFrame | None:
    df = read_dataset(spark, root, "klines", timeframe, market, scope)
    if df is None:
        return None
    day = day_column(df, "klines", timeframe)
    names = {n: resolve(df, n) for n in ("time", "open", "high", "low", "close", "volume")}
    return df.select(F.lit(market).alias("market"), "symbol", day.alias("date"), F.lit(timeframe).alias("timeframe"), F.col(names["time"]).alias("ts"), *(F.col(names[n]).cast("double").alias(n) for n in ("open", "high", "low", "close", "volume")))


def coverage_of(spark: SparkSession, root: str, dataset: str, market: str, timeframe: str, scope: Scope, threshold: float, changed: DataFrame | None = None) -> DataFrame | None:
    df = read_dataset(spark, root, dataset, timeframe, market, scope)
    if df is None:
        return None
    spec = SPECS[dataset]
    if changed is not None:
        part = "month" if spec.has_timeframe and timeframe != "1m" else "date"
        df = _only(df, changed.where(F.col("dataset") == dataset), ["symbol", part])
    there = {c.lower() for c in df.columns}
    first = "ts" if "ts" in there else "min_ts" if "min_ts" in there else "max_ts"
    last = "ts" if "ts" in there else "max_ts" if "max_ts" in there else first
    rows = df.select(
        F.lit(market).alias("market"), F.lit(dataset).alias("dataset"), "symbol", day_column(df, dataset, timeframe).alias("date"),
        F.lit(timeframe if spec.has_timeframe else "").alias("timeframe"), F.col(first).cast("timestamp").alias("ts"), F.col(last).cast("timestamp").alias("last_ts"), "file",
    )
    return cov.coverage(rows, ["market", "dataset", *KEY[1:]], timeframe if spec.has_timeframe else None, threshold, last="last_ts")


def refresh_rollups(store: MetaStore, timeframe: str, market: str, scope: Scope, at: datetime) -> None:
    """Statistics over the whole coverage of the symbols in scope; alignment within its days."""
    covered = store.read("md_partition_coverage").where(F.col("market") == market)
    symbols = Scope(scope.symbols)
    own = (F.col("market") == market) & (F.col("timeframe") == timeframe)
    stats = _stamp(cov.symbol_stats(covered.where(symbols.on(day=None)), timeframe), at, "last_refreshed_utc")
    store.write("md_symbol_dataset_stats", replace_where(store.read("md_symbol_dataset_stats"), stats, own & symbols.on(day=None)))
    aligned = _stamp(cov.alignment(covered.where(scope.on()), timeframe), at)
    store.write("md_alignment_summary", replace_where(store.read("md_alignment_summary"), aligned, own & scope.on()))


def refresh_integrity(store: MetaStore, root: str, market: str, scope: Scope, at: datetime, keys: DataFrame | None = None) -> int:
    bars = _klines(store.spark, root, market, "1m", scope)
    if bars is None:
        return 0
    if keys is not None:
        bars = _only(bars, keys, ["symbol", "date"])
    fresh = _stamp(integrity(bars, KEY), at)
    old = store.read("md_kline_integrity_day")
    store.write("md_kline_integrity_day", upsert(old, fresh, KEY))
    return store.read("md_kline_integrity_day").where(F.col("computed_at_utc") == F.lit(at).cast("timestamp")).count()


def refresh_liquidity(store: MetaStore, root: str, market: str, timeframe: str, scope: Scope, at: datetime, keys: DataFrame | None = None, lookback: int = liq.LOOKBACK, top: int = liq.TOP) -> dict:
    """Base values of ``keys``, or of all in scope, then medians and ranks of their first day and all later ones."""
    bars = _klines(store.spark, root, market, timeframe, scope)
    if bars is None:
        return {"mode": "no_files", "rows": 0}
    if keys is not None:
        bars = _only(bars, keys, ["symbol", "date"])
    base = _stamp(liq.daily_base(bars, KEY), at)
    old = store.read("md_liquidity_daily")
    store.write("md_liquidity_daily", upsert(old, base, KEY, keep=["dv_30d_median", "liquidity_rank_30d", "in_top_100"]))
    table = store.read("md_liquidity_daily")
    own = (F.col("market") == market) & (F.col("timeframe") == timeframe)
    start = table.where(own & (F.col("computed_at_utc") == F.lit(at).cast("timestamp"))).agg(F.min("date")).first()[0]
    if start is None:
        return {"mode": "nothing", "rows": 0}
    end = table.where(own).agg(F.max("date")).first()[0]
    plain = table.where(own).drop("dv_30d_median", "liquidity_rank_30d", "in_top_100")
    ranked = _stamp(liq.rolling_rank_in_range(plain, F.lit(start), F.lit(end), lookback, top), at)
    store.write("md_liquidity_daily", replace_where(table, ranked, own & (F.col("date") >= F.lit(start))))
    return {"mode": "bulk" if keys is None else "incremental", "rows": ranked.count(), "date_from": start.isoformat(), "date_to": end.isoformat()}


def build_metadata(
    spark: SparkSession, root: str, meta_root: str, *, market: str = "futures", datasets=DATASETS, timeframe_filter: str = "1m", liquidity_only: bool = False,
    completeness_threshold: float = 0.98, symbols=None, date_start=None, date_end=None, lookback: int = liq.LOOKBACK, top_n: int = liq.TOP,
) -> dict:
    """Bring all metadata tables of a timeframe up to date; a summary comes back."""
    unknown = set(datasets) - set(DATASETS)
    if unknown:
        raise ValueError(f"unknown datasets: {sorted(unknown)}")
    tf, at, scope, store = timeframe_filter, _now(), scope_of(symbols, date_start, date_end), MetaStore(spark, meta_root)
    files = scan_files(spark, root, datasets, tf, market, scope).cache()
    manifest = store.read("md_file_manifest")
    changed = changed_files(files, manifest).cache()
    n_changed = changed.count()
    first = store.read("md_partition_coverage").where((F.col("timeframe") == tf) & (F.col("market") == market)).isEmpty()
    mode = "liquidity_only" if liquidity_only else "incremental" if not first else "bulk_first_run" if scope.open else "scoped_first_run"
    if not liquidity_only and n_changed:
        parts = [coverage_of(spark, root, d, market, tf, scope, completeness_threshold, None if first else changed) for d in datasets if SPECS[d].has_timeframe or tf == "1m"]
        if parts := [p for p in parts if p is not None]:
            fresh = _stamp(union_by_name(parts), at)
            store.write("md_partition_coverage", upsert(store.read("md_partition_coverage"), fresh, ["market", "dataset", *KEY[1:]]))
    covered = store.read("md_partition_coverage").where(F.col("market") == market).where(scope.on())
    missing = {t: cov.missing_keys(covered, store.read(t), tf).cache() for t in ("md_liquidity_daily", "md_kline_integrity_day", "md_alignment_summary")}
    n_missing = {t: k.count() for t, k in missing.items()}

    kline_parts = changed.where("dataset = 'klines'")
    if tf == "1m":
        kline_keys = kline_parts.select("symbol", F.to_date("date").alias("date"))
    else:
        days = _klines(spark, root, market, tf, scope)
        kline_keys = None if days is None else _only(days.select("symbol", "date", F.date_format("date", "yyyy-MM").alias("month")), kline_parts, ["symbol", "month"]).select("symbol", "date").distinct()
    summary = {"market": market, "timeframe": tf, "mode": mode, "files_scanned": files.count(), "files_changed": n_changed, "missing_keys": n_missing}
    empty_liquidity = store.read("md_liquidity_daily").where((F.col("timeframe") == tf) & (F.col("market") == market)).isEmpty()
    if kline_keys is not None and (not kline_keys.isEmpty() or n_missing["md_liquidity_daily"]):
        keys = kline_keys.union(missing["md_liquidity_daily"].select("symbol", "date")).distinct()
        summary["liquidity"] = refresh_liquidity(store, root, market, tf, scope, at, None if empty_liquidity else keys, lookback, top_n)
    else:
        summary["liquidity"] = {"mode": "skipped", "rows": 0}
    summary["rollups"] = not liquidity_only and bool(n_changed or n_missing["md_alignment_summary"])
    if summary["rollups"]:
        refresh_rollups(store, tf, market, scope, at)
    summary["integrity_rows"] = 0
    if tf == "1m" and not liquidity_only and kline_keys is not None and (not kline_keys.isEmpty() or n_missing["md_kline_integrity_day"]):
        keys = kline_keys.union(missing["md_kline_integrity_day"].select("symbol", "date")).distinct()
        summary["integrity_rows"] = refresh_integrity(store, root, market, scope, at, keys)
    if not liquidity_only:
        store.write("md_file_manifest", merged_manifest(manifest, files, at))
    for df in (files, changed, *missing.values()):
        df.unpersist()
    return summary


def build_kline_integrity(spark: SparkSession, root: str, meta_root: str, *, market: str = "futures", timeframe: str = "1m", date_start=None, date_end=None, symbols=None, recompute: bool = False, changed_files=None) -> dict:
    """Integrity of one-minute klines in scope: of the days of ``changed_files`` if given, else of days without it, or with ``recompute`` of all."""
    if timeframe != "1m":
        raise ValueError("integrity is defined for 1m klines only")
    store, scope = MetaStore(spark, meta_root), scope_of(symbols, date_start, date_end)
    keys = None
    if changed_files is not None:
        found = {(p["symbol"], p["date"]) for p in map(partitions_of, changed_files) if p.get("dataset") == "klines" and p.get("market") == market and p.get("timeframe") == "1m" and "date" in p and "symbol" in p}
        keys = spark.createDataFrame(sorted(found), "symbol string, date string").withColumn("date", F.to_date("date"))
    elif not recompute:
        bars = _klines(spark, root, market, "1m", scope)
        if bars is not None:
            keys = bars.select(*KEY).distinct().join(store.read("md_kline_integrity_day"), KEY, "left_anti")
    return {"rows": refresh_integrity(store, root, market, scope, _now(), keys)}


def backfill_derived_from_coverage(spark: SparkSession, root: str, meta_root: str, *, what: str = "both", market: str = "futures", timeframe: str = "1m", symbols=None, date_start=None, date_end=None) -> dict:
    """Make the rows that coverage has and liquidity or integrity lack, without a scan for changed files."""
    if what not in ("liquidity", "integrity", "both"):
        raise ValueError("what must be liquidity, integrity or both")
    store, scope, at = MetaStore(spark, meta_root), scope_of(symbols, date_start, date_end), _now()
    covered = store.read("md_partition_coverage").where(F.col("market") == market).where(scope.on())
    out: dict = {}
    if what != "integrity":
        keys = cov.missing_keys(covered, store.read("md_liquidity_daily"), timeframe).cache()
        out["liquidity_missing"] = keys.count()
        if out["liquidity_missing"]:
            out["liquidity"] = refresh_liquidity(store, root, market, timeframe, scope, at, keys)
    if what != "liquidity" and timeframe == "1m":
        keys = cov.missing_keys(covered, store.read("md_kline_integrity_day"), timeframe).cache()
        out["integrity_missing"] = keys.count()
        if out["integrity_missing"]:
            out["integrity_rows"] = refresh_integrity(store, root, market, scope, at, keys)
    return out
