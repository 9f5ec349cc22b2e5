"""Validators: rebuilt tables against stored ones, and invariants.

Each check is one small aggregate; statuses decide the run's and the exit code.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date
from tidemark.operators import checks as bad
from tidemark.operators import selectors, tables
from tidemark.operators.bars import daily_bars
from tidemark.plans.metadata import BROADCAST_KEYS, build_metadata, scope_of
from tidemark.schemas import DAILY, DATASETS, KEYS, TABLES, stable_columns
from tidemark.session import remove, shared_scratch
from tidemark.sources.lake import MetaStore, Scope, read_dataset

PASS, WARN, FAIL, ERROR, SKIP = "PASS", "WARN", "FAIL", "ERROR", "SKIP"
STATUSES = (PASS, WARN, FAIL, ERROR, SKIP)
#: Differing rows kept as an artifact.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Artifact:
    kind: str
    path: str
    description: str


@dataclass(frozen=True)
class Check:
    check_id: str
    category: str
    status: str
    target: str
    message: str
    metrics: dict | None = None
    artifacts: list[Artifact] | None = None
    details: dict | None = None

    def to_dict(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None}


@dataclass(frozen=True)
class Run:
    run_id: str
    validator: str
    checks: list[Check] = field(default_factory=list)
    output_dir: str = ""

    @property
    def status(self) -> str:
        there = {c.status for c in self.checks}
        return next((s for s in (ERROR, FAIL, WARN) if s in there), PASS)

    def counts(self) -> dict[str, int]:
        return {s: sum(c.status == s for c in self.checks) for s in STATUSES}

    def to_dict(self) -> dict:
        return {
            "run_id": self.run_id, "validator": self.validator, "status": self.status, "output_dir": self.output_dir,
            "checks": [c.to_dict() for c in self.checks], "check_count": len(self.checks), "counts_by_status": self.counts(),
        }


def exit_code(status: str) -> int:
    return {PASS: 0, WARN: 0, SKIP: 0, FAIL: 1}.get(status, 2)


def _run(validator: str, checks: Sequence[Check], output_dir: str | None) -> Run:
    run = Run(f"{validator}-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid4().hex[:8]}", validator, list(checks), output_dir or "")
    if output_dir:
        os.makedirs(output_dir, exist_ok=True)
        with open(os.path.join(output_dir, "run_summary.json"), "w") as f:
            json.dump(run.to_dict(), f, indent=2, sort_keys=True, default=str)
        with open(os.path.join(output_dir, "checks.jsonl"), "w") as f:
            f.writelines(json.dumps(c.to_dict(), sort_keys=True, default=str) + "\n" for c in run.checks)
    return run


def _sample(df: DataFrame, output_dir: str | None, name: str, about: str) -> list[Artifact] | None:
    if not output_dir:
        return None
    os.makedirs(output_dir, exist_ok=True)
    path = os.path.join(output_dir, f"{name}.csv")
    df.limit(SAMPLE_ROWS).toPandas().to_csv(path, index=False)
    return [Artifact("csv", path, about)]


def _violations(check_id: str, target: str, df: DataFrame, output_dir: str | None, full: bool) -> Check:
    n = df.count()
    message = f"{n} rows" if n else "none"
    found = _sample(df, output_dir, check_id, "offending rows") if n and full else None
    return Check(check_id, "invariant", FAIL if n else PASS, target, message, {"violations": n}, found)


def _same(check_id: str, target: str, expected: DataFrame, actual: DataFrame, output_dir: str | None, full: bool) -> Check:
    """Fingerprints of both sides; with ``full`` the rows that either has beyond the other."""
    e, a = (tuple(tables.fingerprint(df).first()) for df in (expected, actual))
    found = None
    if e != a and full:
        found = _sample(tables.bag_difference(expected, actual), output_dir, check_id, "rows of one side only; left: rebuilt, right: stored")
    return Check(check_id, "rebuild", PASS if e == a else FAIL, target, "equal" if e == a else "differs", {"rebuilt": [str(x) for x in e], "stored": [str(x) for x in a]}, found)


def validate_metadata(spark: SparkSession, root: str, meta_root: str, *, market: str = "futures", timeframe: str = "1m", datasets=DATASETS, profile: str = "smoke", symbols=None, date_start=None, date_end=None, output_dir: str | None = None, scratch: str | None = None) -> Run:
    """Rebuild the tables from the lake and compare their stable columns; then the invariants.

    Medians and ranks depend on rows before the scope and on all symbols, so liquidity is
    rebuilt over everything and compared within the scope.
    """
    if profile not in ("smoke", "full"):
        raise ValueError("profile must be smoke or full")
    full, scope, store, found = profile == "full", scope_of(symbols, date_start, date_end), MetaStore(spark, meta_root), []
    if store._current("md_partition_coverage") is None:
        return _run("metadata", [Check("source.open", "source", ERROR, meta_root, "no metadata there")], output_dir)
    fresh_root = f"{(scratch or shared_scratch(spark)).rstrip('/')}/meta-{uuid4().hex}"
    try:
        build_metadata(spark, root, fresh_root, market=market, datasets=datasets, timeframe_filter=timeframe)
        found.append(Check("rebuild.temp_build", "rebuild", PASS, fresh_root, "rebuilt"))
    except Exception as e:
        return _run("metadata", [Check("rebuild.temp_build", "rebuild", ERROR, fresh_root, f"{type(e).__name__}: {e}")], output_dir)
    fresh = MetaStore(spark, fresh_root)
    for table in TABLES:
        names = [c for c in stable_columns(table) if c != "file_path"]
        pair = []
        for s in (fresh, store):
            df = s.read(table).where(F.col("market") == market)
            if "timeframe" in names:
                df = df.where((F.col("timeframe") == timeframe) | ((F.col("timeframe") == "") & F.lit(timeframe == "1m")))
            if "date" in names:
                df = df.where(scope.on())
            elif "symbol" in names:
                df = df.where(scope.on(day=None))
            pair.append(df.select(*names))
        if table == "md_file_manifest":  # files of other timeframes are not rebuilt
            pair[1] = pair[1].join(pair[0].select("file_rel"), "file_rel", "left_semi").select(*names)
        found.append(_same(f"rebuild.{table}", table, *pair, output_dir, full))
    t = {name: store.read(name).where(F.col("market") == market) for name in TABLES}
    t = {name: df.where(scope.on()) if "date" in df.columns else df for name, df in t.items()}
    covered = t["md_partition_coverage"]
    found += [
        _violations("invariant.funding_non_1m_absent", "md_partition_coverage", bad.misplaced_funding(covered), output_dir, full),
        _violations("invariant.integrity_timeframe_only_1m", "md_kline_integrity_day", bad.not_one_minute(t["md_kline_integrity_day"]), output_dir, full),
        _violations("invariant.coverage_completeness_ratio_bounds", "md_partition_coverage", bad.ratio_out_of_bounds(covered), output_dir, full),
        _violations("invariant.alignment_keys_backed_by_coverage", "md_alignment_summary", bad.alignment_unbacked(t["md_alignment_summary"], covered), output_dir, full),
        _violations("invariant.liquidity_keys_backed_by_coverage_klines", "md_liquidity_daily", bad.liquidity_unbacked(t["md_liquidity_daily"], covered), output_dir, full),
    ]
    remove(spark, fresh_root)
    twice = {name: tables.duplicates(df, KEYS[name]).first()[0] for name, df in t.items()}
    found.append(Check("invariant.no_duplicate_primary_keys", "invariant", FAIL if any(twice.values()) else PASS, "all tables", f"{sum(twice.values())} repeated keys", twice))
    return _run("metadata", found, output_dir)


def validate_derived_1d(spark: SparkSession, root: str, *, dataset: str = "klines", market: str = "futures", symbols=None, months=None, date_start=None, date_end=None, sample_limit: int | None = None, tolerance: float = 1e-9, output_dir: str | None = None) -> Run:
    """Daily bars of the lake against those made anew from one-minute rows."""
    scope = scope_of(symbols, date_start, date_end)
    target = f"{dataset} 1d"
    raw, stored = (read_dataset(spark, root, dataset, tf, market, Scope(scope.symbols)) for tf in ("1m", "1d"))
    if raw is None:
        return _run("derived-1d", [Check("derived.source", "source", SKIP, target, "no one-minute rows")], output_dir)
    expected = daily_bars(raw.where(scope.on()).withColumn("date", F.to_date("date")), ["symbol", "date"], volume=dataset == "klines")
    values = [c.split()[0] for c in DAILY[dataset].split(", ") if not c.startswith("date ")]
    if stored is None:
        stored = spark.createDataFrame([], f"symbol string, month string, file string, {DAILY[dataset]}")
    there = {c.lower() for c in stored.columns}
    types = dict(c.split() for c in DAILY[dataset].split(", "))
    lacking = [v for v in values if v not in there]
    day = F.to_date(next(c for c in ("date", "day", "max_ts") if c in there))
    actual = stored.select("symbol", "month", "file", day.alias("date"), *((F.col(v) if v not in lacking else F.lit(None)).cast(types[v]).alias(v) for v in values))
    actual = actual.where(scope.on())
    months = list(months or [])
    if months:
        expected, actual = (df.where(F.date_format("date", "yyyy-MM").isin(months)) for df in (expected, actual))
    if sample_limit is not None:
        tasks = expected.select("symbol", F.date_format("date", "yyyy-MM").alias("_m")).distinct().orderBy("symbol", "_m").limit(sample_limit)
        expected, actual = (df.join(F.broadcast(tasks) if sample_limit <= BROADCAST_KEYS else tasks, (df["symbol"] == tasks["symbol"]) & (F.date_format(df["date"], "yyyy-MM") == F.col("_m")), "left_semi") for df in (expected, actual))
    found = []
    shape = actual.where(F.col("month") != F.date_format("date", "yyyy-MM")).count()
    found.append(Check("derived.partition_shape", "derived", FAIL if shape else PASS, target, f"{shape} rows outside their month", {"rows": shape}))
    twice = tables.duplicates(actual, ["symbol", "date"]).first()[0]
    found.append(Check("derived.unique_symbol_date", "derived", FAIL if twice else PASS, target, f"{twice} repeated days", {"rows": twice}))
    rollup = [v for v in values if v in ("src_rows", "min_ts", "max_ts", "dollar_volume", "vwap")]
    core = [v for v in values if v not in rollup]
    one = tables.first_rows(actual, ["symbol", "date"], ["file"])
    sides = tables.compare(expected, one, ["symbol", "date"], core, tolerance).where("side <> 'both' or mismatch <> ''")
    counts = {r[0]: r[1] for r in sides.groupBy("side").count().collect()}
    art = _sample(sides, output_dir, f"derived_{dataset}_aggregate_match", "days that are missing, extra or differ") if counts else None
    found.append(Check("derived.aggregate_match", "derived", FAIL if counts else PASS, target, "equal" if not counts else "differs", {"missing": counts.get("left_only", 0), "extra": counts.get("right_only", 0), "mismatched": counts.get("both", 0)}, art))
    optional = [v for v in rollup if v not in lacking]
    if not optional:
        found.append(Check("derived.optional_rollup_fields", "derived", SKIP, target, "not stored"))
    else:
        n = tables.compare(expected, one, ["symbol", "date"], optional, tolerance).where("side = 'both' and mismatch <> ''").count()
        found.append(Check("derived.optional_rollup_fields", "derived", FAIL if n else PASS, target, f"{n} days differ", {"mismatched": n, "lacking": lacking}))
    return _run(f"derived-1d-{dataset}", found, output_dir)


def validate_all(
    spark: SparkSession, root: str, meta_root: str, *, market: str = "futures", profile: str = "smoke", datasets=("klines",), symbols=None, append_date_start=None, append_date_end=None,
    candidate_rank_threshold: int = 150, sample_limit: int | None = None, output_dir: str | None = None,
) -> Run:
    """Metadata, then daily bars of chosen symbols: those given, those near the ranks' limit in an append window, else all candidates."""
    start, end = as_date(append_date_start), as_date(append_date_end)
    append = start is not None or end is not None
    liquidity = MetaStore(spark, meta_root).read("md_liquidity_daily")
    if symbols:
        chosen = sorted(set(symbols))
    elif append:
        picked = selectors.near_threshold(liquidity, 100, max(1, candidate_rank_threshold - 100), start, end, market=market)
        chosen = sorted(r[0] for r in picked.select("symbol").collect())
    else:
        chosen = sorted(r[0] for r in selectors.candidate_superset(liquidity, candidate_rank_threshold, market=market).select("symbol").collect())
    sub = lambda name: os.path.join(output_dir, name) if output_dir else None
    runs = [validate_metadata(spark, root, meta_root, market=market, profile="smoke" if append else profile, symbols=symbols, date_start=start, date_end=end, output_dir=sub("metadata"))]
    for d in datasets:
        if chosen:
            runs.append(validate_derived_1d(spark, root, dataset=d, market=market, symbols=chosen, date_start=start, date_end=end, sample_limit=sample_limit, output_dir=sub(f"derived-{d}")))
        else:
            runs.append(Run(f"derived-1d-{d}-skipped", f"derived-1d-{d}", [Check("derived.no_symbols", "derived", SKIP, d, "no symbol chosen")]))
    skipped = lambda r: all(c.status == SKIP for c in r.checks)
    found = [Check(f"child.{r.validator}", "child", SKIP if skipped(r) else r.status, r.validator, f"{len(r.checks)} checks", r.counts(), details={"run_id": r.run_id}) for r in runs]
    run = _run("all", found, output_dir)
    if output_dir:
        with open(os.path.join(output_dir, "child_runs.json"), "w") as f:
            json.dump([r.to_dict() for r in runs], f, indent=2, sort_keys=True, default=str)
    return run


def validate(spark: SparkSession, root: str, meta_root: str, check: str = "all", **options) -> Run:
    if check == "metadata":
        return validate_metadata(spark, root, meta_root, **options)
    if check == "derived-1d":
        return validate_derived_1d(spark, root, **options)
    if check == "all":
        return validate_all(spark, root, meta_root, **options)
    raise ValueError(f"unknown check: {check!r}")
