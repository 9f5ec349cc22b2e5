"""Archives, downloads, command line."""

import json
import os
import subprocess
import sys
import zipfile
from datetime import date

import pytest

from tidemark.cli import _merged, _parser
from tidemark.plans.fetch import fetch_futures, window
from tidemark.plans.ingest import ingest_local_downloads_to_lake
from tidemark.plans.validate import ERROR, FAIL, PASS, SKIP, WARN, Check, Run, exit_code
from tidemark.sources import remote
from tidemark.sources.archives import in_flight, read_csv_member, zip_is_valid
from tidemark.sources.lake import read_dataset
from tidemark.sources.paths import archive_key

D = date(2025, 1, 1)


def archive(root, key, name, text):
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(name, text)
    os.utime(path, (1, 1))
    return path


def test_ingest(spark, tmp_path):
    src, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    archive(src, archive_key("XBTUSDM", "klines", D), "a.csv", "time,open,high,low,close,volume\n1.7356896E12,1,2,0.5,1.5,10\n1735689660000,1.5,2,1,2,\n")
    archive(src, archive_key("A", "mark", D), "a.csv", "time,open,high,low,close\n1735689600000,1,2,0.5,1.5\n")
    archive(src, archive_key("A", "index", D), "a.csv", "time,price\n1735689600000,1\n")
    archive(src, archive_key("A", "funding", D), "a.csv", "﻿symbol;time;fundingRate\nA;1735689600000;0.001\n")
    archive(src, archive_key("A", "klines", date(2025, 2, 1)), "a.csv", "time,open\n")
    bad = archive(src, archive_key("B", "klines", D), "a.csv", "x")
    with open(bad, "wb") as f:
        f.write(b"no zip")
    os.utime(bad, (1, 1))
    fresh = archive(src, archive_key("C", "klines", D), "a.csv", "x")
    os.utime(fresh)
    out = ingest_local_downloads_to_lake(spark, src, lake, start_date="2025-01-01", end_date="2025-01-31")
    d = out["datasets"]
    assert d["klines"] == {"found": 3, "in_flight": 1, "invalid": 1, "skipped": 0, "done": 1, "failed": 0}
    assert d["mark"]["done"] == 1 and d["funding"]["done"] == 1 and d["index"]["failed"] == 1 and not out["ok"]
    k = read_dataset(spark, lake, "klines").orderBy("time_ms").collect()
    assert [(r.symbol, r.date, r.time_ms, r.close, r.volume) for r in k] == [("BTCUSDM", "2025-01-01", 1735689600000, 1.5, 10.0), ("BTCUSDM", "2025-01-01", 1735689660000, 2.0, None)]
    assert str(k[0].ts) == "2025-01-01 00:00:00"
    assert read_dataset(spark, lake, "funding").first().funding_rate == 0.001
    log = [json.loads(x) for x in open(os.path.join(lake, "_errors.jsonl"))]
    assert {x["dataset"] for x in log} == {"klines", "index"}
    again = ingest_local_downloads_to_lake(spark, src, lake, start_date="2025-01-01", end_date="2025-01-31", datasets=["klines", "mark"])
    assert again["datasets"]["klines"]["skipped"] == 1 and again["datasets"]["mark"]["done"] == 0
    with pytest.raises(ValueError):
        ingest_local_downloads_to_lake(spark, src, lake, start_date="2025-02-01", end_date="2025-01-01")


def test_archives(tmp_path):
    two = tmp_path / "two.zip"
    with zipfile.ZipFile(two, "w") as z:
        z.writestr("a.csv", "x")
        z.writestr("b.csv", "x")
    assert zip_is_valid(str(two)) and not zip_is_valid(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        read_csv_member(two.read_bytes(), "klines")
    part = tmp_path / "x.part"
    part.touch()
    os.utime(part, (1, 1))
    assert in_flight(str(part)) and in_flight(str(two))


def test_fetch_plan_and_download(spark, tmp_path):
    keys = [archive_key("A", "klines", date(2025, 1, i)) for i in (1, 2)]
    archive(str(tmp_path), keys[0], "a.csv", "x")
    lister = lambda s, d, y, m, tf: [*keys, "junk.txt"]
    out = fetch_futures(spark, str(tmp_path), "A", "klines", lister=lister, start_date="2025-01-01", end_date="2025-01-05", dry_run=True)
    assert (out["requested"], out["remote_listed"], out["planned"], out["missing_remote"], out["errors"]) == (5, 2, 1, 3, 0)
    get = lambda path, params, timeout: (200, b"zip")
    out = fetch_futures(spark, str(tmp_path), ["A"], ["klines"], get=get, lister=lister, start_date="2025-01-01", end_date="2025-01-05")
    assert out["downloaded"] == 1 and open(tmp_path / keys[1], "rb").read() == b"zip"

    def broken(*a):
        raise OSError("down")

    out = fetch_futures(spark, str(tmp_path), "A", "funding", lister=broken, start_date="2025-01-01", end_date="2025-01-05", dry_run=True)
    assert out["errors"] == 1 and out["planned"] == 0
    with pytest.raises(ValueError):
        fetch_futures(spark, str(tmp_path), "A", "other", lister=lister, days_back=1)


def test_windows():
    today = date(2025, 1, 10)
    assert window(n_days=3, today=today) == (date(2025, 1, 7), date(2025, 1, 9))
    assert window("2025-01-01", "2025-02-01", today=today) == (date(2025, 1, 1), date(2025, 1, 9))
    for a in ({"n_days": 1, "start_date": "2025-01-01"}, {"start_date": "2025-01-10", "end_date": "2025-01-10"}, {}):
        with pytest.raises(ValueError):
            window(**a, today=today)


@pytest.mark.parametrize(("status", "said"), [(404, "missing_remote"), (401, "forbidden"), (403, "forbidden"), (418, "client_error_418"), (200, "downloaded")])
def test_download_statuses(tmp_path, status, said):
    assert remote.download(lambda *a: (status, b""), "d/k.zip", str(tmp_path)) == said


def test_download_tries_again(tmp_path):
    seen, waits = [], []

    def get(*a):
        seen.append(1)
        if len(seen) == 1:
            raise OSError("reset")
        return (503, b"") if len(seen) < 4 else (200, b"x")

    assert remote.download(get, "k.zip", str(tmp_path), sleep=waits.append) == "downloaded" and waits == [1.0, 2.0, 3.0]
    assert remote.download(get, "k.zip", str(tmp_path)) == "exists" and not os.path.exists(tmp_path / "k.zip.part")
    with pytest.raises(OSError):
        remote.download(lambda *a: (500, b""), "j.zip", str(tmp_path), retries=2, sleep=waits.append)


def test_listing_page():
    xml = b'<R xmlns="http://s3/"><Contents><Key>a/x.zip</Key></Contents><Contents><Key>a/x.zip.CHECKSUM</Key></Contents><CommonPrefixes><Prefix>a/b/</Prefix></CommonPrefixes></R>'
    assert remote.list_page(lambda *a: (200, xml), "a/") == (["a/x.zip", "a/x.zip.CHECKSUM"], ["a/b/"])
    assert remote.list_month(lambda *a: (200, xml), "A", "funding", 2025, 1) == ["a/x.zip"]


def test_statuses():
    check = lambda s: Check("c", "x", s, "t", "m")
    assert Run("r", "v", [check(WARN), check(FAIL), check(ERROR)]).status == ERROR
    assert Run("r", "v", [check(WARN), check(FAIL)]).status == FAIL and Run("r", "v", [check(SKIP)]).status == PASS
    assert [exit_code(s) for s in (PASS, WARN, SKIP, FAIL, ERROR, "?")] == [0, 0, 0, 1, 2, 2]


def test_command_line():
    a = _parser().parse_args(["validate", "derived-1d", "--root", "r", "--meta-root", "m", "--symbols", "A", "B", "--symbol", "A", "--month", "2025-01"])
    assert _merged(a.symbols, a.symbol) == ["A", "B"] and _merged(a.months, a.month) == ["2025-01"]
    for name in ("build-metadata", "build-kline-integrity", "backfill-derived", "resample-1m-to-1d", "ingest-local-downloads-to-lake", "fetch-futures", "validate"):
        r = subprocess.run([sys.executable, "-m", "tidemark.cli", name, "--help"], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        assert r.returncode == 0 and "usage" in r.stdout


def test_command_line_options():
    parse = _parser().parse_args
    a = parse(["ingest-local-downloads-to-lake", "--root", "r", "--downloads", "d", "--startdate", "a", "--enddate", "b", "--assets", "A,B", "C", "--timeframes", "1m", "1h", "--no-mark", "--done", "targets"])
    assert _merged(a.symbols) == ["A", "B", "C"] and a.timeframes == ["1m", "1h"] and a.klines and not a.mark and a.done == "targets"
    a = parse(["fetch-futures", "--out-root", "o", "--symbols", "A", "--url", "u", "--timeframe", "1h", "--retries", "2", "--backoff-s", "0.5", "--timeout", "1", "2", "--sleep-s", "0", "--days", "3"])
    assert (a.timeframe, a.retries, a.backoff_s, a.timeout, a.sleep_s, a.days) == ("1h", 2, 0.5, [1.0, 2.0], 0.0, 3)
    roots = ["--root", "r", "--meta-root", "m"]
    a = parse(["build-kline-integrity", *roots, "--changed-files", "x", "y", "--start-date", "2025-01-01", "--timeframe", "1m"])
    assert a.changed_files == ["x", "y"] and a.date_start == "2025-01-01"
    assert not parse(["resample-1m-to-1d", "--root", "r", "--no-overwrite"]).overwrite and parse(["resample-1m-to-1d", "--root", "r", "--changed-files", "f"]).changed_files == ["f"]
    assert parse(["validate", "metadata", *roots, "--datasets", "klines", "--timeframe-filter", "1d"]).datasets == ["klines"]
    assert parse(["validate", "all", *roots, "--derived-datasets", "mark"]).derived_datasets == ["mark"] and parse(["validate", "derived-1d", *roots, "--tolerance", "0.1"]).tolerance == 0.1


def test_ways_to_find_what_is_done(spark, tmp_path):
    src, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    for day in (1, 2):
        archive(src, archive_key("A", "klines", date(2025, 1, day)), "a.csv", "time,open,high,low,close,volume\n1735689600000,1,2,0.5,1.5,10\n")
    run = lambda end, **more: ingest_local_downloads_to_lake(spark, src, lake, start_date="2025-01-01", end_date=end, datasets=["klines"], **more)["datasets"]["klines"]
    assert run("2025-01-01")["done"] == 1
    for how, skipped in (("targets", 1), ("scan", 2), ("skip", 0)):
        found = run("2025-01-02", done=how)
        assert (found["skipped"], found["done"]) == (skipped, 2 - skipped), how
    with pytest.raises(ValueError):
        run("2025-01-02", done="other")


def test_integrity_of_changed_files(spark, tmp_path):
    from lake import one_row_days
    from tidemark.plans.metadata import build_kline_integrity

    root, meta = str(tmp_path / "lake"), str(tmp_path / "meta")
    one_row_days(root, "A", D, 3)
    changed = [f"{root}/futures/klines/timeframe=1m/symbol=A/date=2025-01-02/data.parquet", f"{root}/futures/mark/timeframe=1m/symbol=A/date=2025-01-03/data.parquet"]
    assert build_kline_integrity(spark, root, meta, changed_files=changed)["rows"] == 1
    assert build_kline_integrity(spark, root, meta)["rows"] == 2


def test_reads_are_narrowed_to_a_scope(spark, tmp_path):
    from lake import one_row_days
    from tidemark.sources.lake import Scope, _narrowed

    root = str(tmp_path)
    one_row_days(root, "A", date(2025, 1, 30), 4)
    one_row_days(root, "B", date(2025, 1, 30), 4)
    scope = Scope(("A", "none"), date(2025, 1, 31), date(2025, 2, 1))
    base = f"{root}/futures/klines/timeframe=1m"
    assert _narrowed(spark, base, scope, "date") == [f"{base}/symbol=A/date=2025-01-*", f"{base}/symbol=A/date=2025-02-*"]
    assert sorted((r.symbol, r.date) for r in read_dataset(spark, root, "klines", scope=scope).collect()) == [("A", "2025-01-31"), ("A", "2025-02-01")]
    assert read_dataset(spark, root, "klines", scope=Scope(("none",))).count() == 0


def test_command_runs(spark, tmp_path, capsys):
    from lake import one_row_days
    from tidemark.cli import main

    one_row_days(tmp_path / "lake", "A", D, 2)
    roots = ["--root", str(tmp_path / "lake"), "--meta-root", str(tmp_path / "meta")]
    assert main(["build-metadata", *roots, "--datasets", "klines"]) == 0
    assert main(["validate", "metadata", *roots]) == 0 and main(["validate", "metadata", "--root", "r", "--meta-root", str(tmp_path / "none")]) == 2
