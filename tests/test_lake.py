import json
import os
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lake import minutes, one_row_days, put
from tidemark.plans.metadata import backfill_derived_from_coverage, build_kline_integrity, build_metadata
from tidemark.plans.research import build_base_panel, build_universe_daily
from tidemark.plans.resample import plan, resample_bars
from tidemark.plans.validate import FAIL, PASS, SKIP, exit_code, validate, validate_all, validate_derived_1d, validate_metadata
from tidemark.sources.lake import MetaStore, Scope, read_dataset
from tidemark.sources.manifest import scan_files
from tidemark.sources.paths import archive_key, day_of_key, dataset_glob, leaf_dir, partitions_of

D = date(2025, 1, 1)


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_paths():
    assert leaf_dir("futures", "klines", "A", "1m", D) == "futures/klines/timeframe=1m/symbol=A/date=2025-01-01"
    assert leaf_dir("futures", "klines", "A", "1d", month="2025-01").endswith("timeframe=1d/symbol=A/month=2025-01")
    assert leaf_dir("futures", "funding", "A", day=D) == "futures/funding/symbol=A/date=2025-01-01"
    assert partitions_of("/x/futures/mark/timeframe=1d/symbol=B/month=2025-02/p.parquet") == {"market": "futures", "dataset": "mark", "timeframe": "1d", "symbol": "B", "month": "2025-02"}
    assert dataset_glob("/l", "futures", "klines", "1m").endswith("timeframe=1m/symbol=*/date=*/*.parquet")
    assert day_of_key(archive_key("XBTUSDM", "klines", D)) == D and "BTCUSDM-1m-2025-01-01.zip" in archive_key("XBTUSDM", "klines", D)
    assert day_of_key("nothing.zip") is None


def test_integrity_cases(spark, tmp_path):
    base = minutes(D)
    put(tmp_path, base, "klines", "FULL", D)
    put(tmp_path, pd.concat([base, base.iloc[[10]]]), "klines", "TWICE", D)
    put(tmp_path, base.drop(index=5), "klines", "GAP", D)
    meta = str(tmp_path / "meta")
    assert build_kline_integrity(spark, str(tmp_path), meta)["rows"] == 3
    got = rows(MetaStore(spark, meta).read("md_kline_integrity_day"), "symbol", "num_rows", "distinct_minute_cnt", "gap_rows_vs_expected", "duplicate_rows")
    assert got == [("FULL", 1440, 1440, 0, 0), ("GAP", 1439, 1439, 1, 0), ("TWICE", 1441, 1440, 0, 1)]
    assert build_kline_integrity(spark, str(tmp_path), meta)["rows"] == 0
    with pytest.raises(ValueError):
        build_kline_integrity(spark, str(tmp_path), meta, timeframe="1d")


def test_rolling_median_and_incremental(spark, tmp_path):
    root, meta = str(tmp_path / "lake"), str(tmp_path / "meta")
    one_row_days(root, "TEST", D, 40)
    one = build_metadata(spark, root, meta, datasets=["klines"])
    assert one["mode"] == "bulk_first_run" and one["files_changed"] == 40
    liquidity = MetaStore(spark, meta).read("md_liquidity_daily")
    day35 = liquidity.where(F.col("date") == D + timedelta(days=34)).first()
    assert day35.dv_30d_median == 20.5 and day35.liquidity_rank_30d == 1 and day35.in_top_100
    before = {r.date: r.computed_at_utc for r in liquidity.collect()}
    # nothing new: nothing is made again
    two = build_metadata(spark, root, meta, datasets=["klines"])
    assert two["files_changed"] == 0 and two["liquidity"]["mode"] == "skipped" and not two["rollups"] and two["integrity_rows"] == 0
    assert {r.date: r.computed_at_utc for r in MetaStore(spark, meta).read("md_liquidity_daily").collect()} == before
    # one file touched: its day and later ones only
    touched = put(root, minutes(D + timedelta(days=20), 1, volume=500.0), "klines", "TEST", D + timedelta(days=20))
    os.utime(touched, (1, 1))
    three = build_metadata(spark, root, meta, datasets=["klines"])
    assert three["files_changed"] == 1
    after = {r.date: r for r in MetaStore(spark, meta).read("md_liquidity_daily").collect()}
    assert {d for d, r in after.items() if r.computed_at_utc != before[d]} == {D + timedelta(days=i) for i in range(20, 40)}
    # and equal to a build from nothing
    build_metadata(spark, root, str(tmp_path / "meta2"), datasets=["klines"])
    names = ("symbol", "date", "dollar_volume", "dv_30d_median", "liquidity_rank_30d")
    assert rows(MetaStore(spark, meta).read("md_liquidity_daily"), *names) == rows(MetaStore(spark, str(tmp_path / "meta2")).read("md_liquidity_daily"), *names)
    manifest = {r.file_rel: r for r in MetaStore(spark, meta).read("md_file_manifest").collect()}
    assert len(manifest) == 40 and all(r.first_seen_utc <= r.last_seen_utc for r in manifest.values()) and any(r.first_seen_utc < r.last_seen_utc for r in manifest.values())


def test_all_datasets_repair_and_validation(spark, tmp_path):
    root, meta = str(tmp_path / "lake"), str(tmp_path / "meta")
    for i in range(2):
        d = D + timedelta(days=i)
        put(root, minutes(d, 10, 2.0), "klines", "A", d)
        put(root, minutes(d, 1440, 3.0), "klines", "B", d)
        put(root, minutes(d, 5).drop(columns="volume"), "mark", "A", d)
        put(root, minutes(d, 2)[["time_ms", "ts"]].assign(symbol="A", funding_rate=0.1), "funding", "A", d, None)
    put(root, minutes(D, 5).drop(columns="volume"), "index", "A", D)
    build_metadata(spark, root, meta)
    store = MetaStore(spark, meta)
    cov = {(r.dataset, r.symbol, r.date): r for r in store.read("md_partition_coverage").collect()}
    assert len(cov) == 9
    funding = cov["funding", "A", D]
    assert funding.timeframe == "" and funding.expected_rows is None and funding.is_suspect is None and funding.num_rows == 2
    assert cov["klines", "B", D].completeness_ratio == 1.0 and not cov["klines", "B", D].is_suspect and cov["klines", "A", D].is_suspect
    al = {(r.symbol, r.date): r for r in store.read("md_alignment_summary").collect()}
    assert al["A", D].all_core_present and al["A", D].core_missing_mask == "" and al["A", D].has_funding
    assert al["A", D + timedelta(days=1)].core_missing_mask == "index" and al["B", D].core_missing_mask == "mark,index"
    stats = {(r.dataset, r.symbol): r for r in store.read("md_symbol_dataset_stats").collect()}
    assert stats["funding", "A"].timeframe == "1m" and stats["funding", "A"].days_complete == 2 and stats["funding", "A"].pct_days_complete is None
    assert stats["klines", "B"].pct_days_complete == 1.0 and stats["klines", "A"].days_complete == 0

    run = validate_metadata(spark, root, meta, profile="full", output_dir=str(tmp_path / "v"))
    assert run.status == PASS and exit_code(run.status) == 0, [c for c in run.checks if c.status != PASS]
    assert json.load(open(tmp_path / "v" / "run_summary.json"))["status"] == PASS

    # rows that are gone come back; those there keep their stamps
    liq = store.read("md_liquidity_daily")
    kept = {(r.symbol, r.date): r.computed_at_utc for r in liq.collect()}
    store.write("md_liquidity_daily", liq.where(F.col("date") == F.lit(D)))
    integ = store.read("md_kline_integrity_day")
    store.write("md_kline_integrity_day", integ.where("symbol = 'A'"))
    assert validate_metadata(spark, root, meta).status == FAIL
    out = backfill_derived_from_coverage(spark, root, meta)
    assert out["liquidity_missing"] == 2 and out["integrity_missing"] == 2
    now = {(r.symbol, r.date): r.computed_at_utc for r in store.read("md_liquidity_daily").collect()}
    assert set(now) == set(kept) and now["A", D] == kept["A", D] and now["A", D + timedelta(days=1)] != kept["A", D + timedelta(days=1)]
    assert validate_metadata(spark, root, meta).status == PASS

    # broken tables are found
    c = store.read("md_partition_coverage")
    store.write("md_partition_coverage", c.withColumn("completeness_ratio", F.when((F.col("symbol") == "B"), 1.5).otherwise(F.col("completeness_ratio"))))
    i = store.read("md_kline_integrity_day")
    store.write("md_kline_integrity_day", i.withColumn("timeframe", F.when(F.col("symbol") == "B", "1d").otherwise(F.col("timeframe"))))
    q = store.read("md_liquidity_daily")
    store.write("md_liquidity_daily", q.union(q.limit(1)))
    bad = {c.check_id for c in validate_metadata(spark, root, meta).checks if c.status == FAIL}
    assert {"invariant.coverage_completeness_ratio_bounds", "invariant.integrity_timeframe_only_1m", "invariant.no_duplicate_primary_keys"} <= bad
    assert validate_metadata(spark, root, str(tmp_path / "none")).status == "ERROR" and exit_code("ERROR") == 2


def test_resample_and_derived_validation(spark, tmp_path):
    root, meta = str(tmp_path / "lake"), str(tmp_path / "meta")
    for i in (0, 1, 31):
        d = D + timedelta(days=i)
        df = minutes(d, 30, 10.0 + i)
        df["close"] = [10.0 + i + k for k in range(30)]
        df["high"] = df["close"] + 1
        put(root, df, "klines", "A", d)
    assert resample_bars(spark, root, plan_only=True)["planned"] == 2
    out = resample_bars(spark, root)
    assert out["ok"] and [t["status"] for t in out["tasks"]] == ["done", "done"]
    got = read_dataset(spark, root, "klines", "1d").orderBy("date").collect()
    assert [(str(r.date), r.open, r.high, r.low, r.close, r.volume, r.src_rows) for r in got] == [
        ("2025-01-01", 10.0, 40.0, 10.0, 39.0, 30.0, 30), ("2025-01-02", 11.0, 41.0, 11.0, 40.0, 30.0, 30), ("2025-02-01", 41.0, 71.0, 41.0, 70.0, 30.0, 30)
    ]
    assert plan(spark, root, overwrite=False).count() == 0
    assert rows(plan(spark, root, changed_files=[f"{root}/futures/klines/timeframe=1m/symbol=A/date=2025-02-01/data.parquet", "/spot/klines/x"]), "symbol", "month") == [("A", "2025-02")]
    run = validate_derived_1d(spark, root, output_dir=str(tmp_path / "v"))
    assert run.status == PASS, [c for c in run.checks if c.status != PASS]
    # the 1d build keeps to its timeframe, and leaves 1m rows alone
    build_metadata(spark, root, meta, datasets=["klines"])
    build_metadata(spark, root, meta, datasets=["klines"], timeframe_filter="1d")
    store = MetaStore(spark, meta)
    assert rows(store.read("md_partition_coverage").groupBy("timeframe").count(), "timeframe", "count") == [("1d", 3), ("1m", 3)]
    assert validate_all(spark, root, meta).status == PASS
    # changed, missing and extra days
    stored = read_dataset(spark, root, "klines", "1d").where("month = '2025-01'").drop("file", "timeframe", "symbol", "month").toPandas()
    stored["close"] += 0.001
    for c in ("min_ts", "max_ts"):
        stored[c] = stored[c].dt.tz_localize("UTC").astype("datetime64[us, UTC]")
    stored = pd.concat([stored.iloc[:1], stored.iloc[:1].assign(date=date(2025, 1, 9))])
    path = tmp_path / "lake/futures/klines/timeframe=1d/symbol=A/month=2025-01"
    for f in path.glob("*"):
        f.unlink()
    for f in path.glob(".*"):
        f.unlink()
    stored.to_parquet(path / "data.parquet", index=False)
    check = next(c for c in validate_derived_1d(spark, root).checks if c.check_id == "derived.aggregate_match")
    assert check.status == FAIL and check.metrics == {"missing": 1, "extra": 1, "mismatched": 1}
    assert validate(spark, root, meta, "derived-1d", dataset="mark").checks[0].status == SKIP
    with pytest.raises(ValueError):
        validate(spark, root, meta, "other")


def test_days_come_from_folders(spark, tmp_path):
    """A time of another day, in a session of another zone, stays in its file's day."""
    root = str(tmp_path)
    df = minutes(date(2024, 9, 29), 2)
    df["ts"] = pd.to_datetime([datetime(2024, 9, 29, 0, 10), datetime(2024, 9, 29, 23, 50)]).astype("datetime64[us]").tz_localize("UTC")
    put(root, df, "klines", "A", date(2024, 9, 29))
    put(root, df, "klines", "A", date(2024, 9, 30))
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        build_metadata(spark, root, str(tmp_path / "m"), datasets=["klines"])
        got = rows(MetaStore(spark, str(tmp_path / "m")).read("md_partition_coverage"), "date", "num_rows")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(date(2024, 9, 29), 2), (date(2024, 9, 30), 2)]


def test_scan_scope(spark, tmp_path):
    root = str(tmp_path)
    for s in "AB":
        for i in range(3):
            put(root, minutes(D + timedelta(days=i), 1), "klines", s, D + timedelta(days=i))
    put(root, minutes(D, 1), "klines", "A", D, "1d")
    put(root, minutes(D, 1), "klines", "A", date(2025, 3, 1), "1d")
    put(root, minutes(D, 1), "funding", "A", D, None)
    count = lambda **k: scan_files(spark, root, ["klines", "funding"], **k).count()
    assert count() == 7 and count(timeframe="1d") == 2 and count(timeframe="*") == 9
    assert count(scope=Scope(("A",))) == 4 and count(scope=Scope(None, D, D)) == 3
    assert count(timeframe="1d", scope=Scope(None, date(2025, 1, 20), date(2025, 2, 3))) == 1


def test_universe_and_panel_files(spark, tmp_path):
    root, meta = str(tmp_path / "lake"), str(tmp_path / "meta")
    one_row_days(root, "A", D, 6)
    one_row_days(root, "B", D, 4)
    build_metadata(spark, root, meta, datasets=["klines"])
    resample_bars(spark, root)
    u = build_universe_daily(spark, meta, start_date="2025-01-02", end_date="2025-01-07", entry_n=1, exit_n=2, out=str(tmp_path / "u.parquet"))
    assert (tmp_path / "u.meta.json").exists()
    assert rows(u.where("symbol = 'A'"), "day") == [(D + timedelta(days=i),) for i in range(1, 7)]
    p = build_base_panel(spark, root, str(tmp_path / "u.parquet"), out=str(tmp_path / "p.parquet"))
    a = {r.day: r for r in p.where("symbol = 'A'").collect()}
    assert a[D + timedelta(days=1)].ret_1d == 0.0 and a[D + timedelta(days=6)].close is None and a[D + timedelta(days=5)].fwd_ret_1d is None
    with pytest.raises(FileExistsError):
        build_base_panel(spark, root, str(tmp_path / "u.parquet"), out=str(tmp_path / "p.parquet"))
