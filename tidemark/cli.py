"""Command line: one subcommand to each operation of the API."""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.schemas import DATASETS


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *, root: bool = True, meta: bool = False, where=commands) -> argparse.ArgumentParser:
        p = where.add_parser(name)
        if root:
            p.add_argument("--root", required=True, help="the lake")
        if meta:
            p.add_argument("--meta-root", required=True, help="the metadata tables")
        p.add_argument("--market", default="futures")
        return p

    def named(p: argparse.ArgumentParser) -> None:
        p.add_argument("--symbols", nargs="*", default=[], help="separated by spaces or commas")
        p.add_argument("--symbol", action="append", default=[])

    def scoped(p: argparse.ArgumentParser) -> None:
        named(p)
        p.add_argument("--date-start", "--start-date")
        p.add_argument("--date-end", "--end-date")

    p = command("build-metadata", meta=True)
    scoped(p)
    p.add_argument("--datasets", nargs="*", default=list(DATASETS), choices=DATASETS)
    p.add_argument("--timeframe-filter", default="1m")
    p.add_argument("--liquidity-only", action="store_true")
    p.add_argument("--completeness-threshold", type=float, default=0.98)
    p = command("build-kline-integrity", meta=True)
    scoped(p)
    p.add_argument("--timeframe", default="1m")
    p.add_argument("--changed-files", nargs="+", help="only the days of these files")
    p.add_argument("--recompute", action="store_true")
    p = command("backfill-derived", meta=True)
    scoped(p)
    p.add_argument("--timeframe", default="1m")
    p.add_argument("--what", default="both", choices=("liquidity", "integrity", "both"))
    p = command("resample-1m-to-1d")
    p.add_argument("--dataset", default="klines", choices=("klines", "mark", "index"))
    p.add_argument("--changed-files", nargs="+", help="only the months of these files")
    p.add_argument("--test-symbols", nargs="*", default=[])
    p.add_argument("--test-months", nargs="*", default=[])
    p.add_argument("--max-tasks", type=int)
    p.add_argument("--plan-only", action="store_true")
    p.add_argument("--overwrite", action="store_true", default=True)
    p.add_argument("--no-overwrite", dest="overwrite", action="store_false")
    p = command("ingest-local-downloads-to-lake")
    p.add_argument("--downloads", required=True)
    p.add_argument("--startdate", required=True)
    p.add_argument("--enddate", required=True)
    p.add_argument("--symbols", "--assets", nargs="*", default=[], help="separated by spaces or commas")
    p.add_argument("--timeframes", nargs="+", default=["1m"])
    p.add_argument("--done", default="scan", choices=("scan", "targets", "skip"), help="how partitions that are there are found")
    for d in DATASETS:
        p.add_argument(f"--include-{d}", dest=d, action="store_true", default=True)
        p.add_argument(f"--no-{d}", dest=d, action="store_false")
    p = command("fetch-futures", root=False)
    p.add_argument("--out-root", required=True)
    p.add_argument("--symbols", nargs="+", required=True)
    p.add_argument("--datatype", nargs="+", default=["klines"])
    p.add_argument("--url", required=True, help="address of the archive store")
    p.add_argument("--timeframe", default="1m")
    p.add_argument("--days", type=int)
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--sleep-s", type=float, default=0.02)
    p.add_argument("--retries", type=int, default=6)
    p.add_argument("--backoff-s", type=float, default=1.0)
    p.add_argument("--timeout", nargs=2, type=float, metavar=("CONNECT", "READ"), default=(10.0, 300.0))
    p.add_argument("--dry-run", action="store_true")
    kinds = commands.add_parser("validate").add_subparsers(dest="check", required=True)
    for kind in ("metadata", "derived-1d", "all"):
        p = command(kind, meta=True, where=kinds)
        named(p)
        p.add_argument("--output-dir")
        if kind == "metadata":
            p.add_argument("--datasets", nargs="+", default=list(DATASETS), choices=DATASETS)
            p.add_argument("--timeframe-filter", default="1m")
        if kind == "all":
            p.add_argument("--derived-datasets", nargs="+", default=["klines"], choices=("klines", "mark", "index"))
        if kind != "derived-1d":
            p.add_argument("--profile", default="smoke", choices=("smoke", "full"))
        if kind == "all":
            p.add_argument("--append-date-start")
            p.add_argument("--append-date-end")
            p.add_argument("--candidate-rank-threshold", type=int, default=150)
        else:
            p.add_argument("--date-start")
            p.add_argument("--date-end")
        if kind == "derived-1d":
            p.add_argument("--tolerance", type=float, default=1e-9)
            p.add_argument("--dataset", default="klines", choices=("klines", "mark", "index"))
            p.add_argument("--months", nargs="*", default=[])
            p.add_argument("--month", action="append", default=[])
        if kind != "metadata":
            p.add_argument("--sample-limit", type=int)
    return parser


def _merged(*lists: list[str]) -> list[str] | None:
    """Distinct names in order, each list's items split at commas; None if there are none."""
    return list(dict.fromkeys(x for one in lists for item in one for x in item.split(",") if x)) or None


def _client(url: str):
    import requests

    session = requests.Session()

    def get(path: str, params: dict, timeout):
        r = session.get(f"{url.rstrip('/')}/{path}", params=params, timeout=timeout)
        return r.status_code, r.content

    return get


def dispatch(a: argparse.Namespace, spark) -> tuple[dict, int]:
    from tidemark import api
    from tidemark.plans import validate as v

    symbols = _merged(getattr(a, "symbols", []), getattr(a, "symbol", []))
    dates = {k: getattr(a, k, None) for k in ("date_start", "date_end")}
    if a.command == "build-metadata":
        return api.build_metadata(spark, a.root, a.meta_root, market=a.market, datasets=a.datasets, timeframe_filter=a.timeframe_filter, liquidity_only=a.liquidity_only, completeness_threshold=a.completeness_threshold, symbols=symbols, **dates), 0
    if a.command == "build-kline-integrity":
        return api.build_kline_integrity(spark, a.root, a.meta_root, market=a.market, timeframe=a.timeframe, symbols=symbols, recompute=a.recompute, changed_files=a.changed_files, **dates), 0
    if a.command == "backfill-derived":
        return api.backfill_derived_from_coverage(spark, a.root, a.meta_root, what=a.what, market=a.market, timeframe=a.timeframe, symbols=symbols, **dates), 0
    if a.command == "resample-1m-to-1d":
        return api.resample_1m_to_1d(spark, a.root, dataset=a.dataset, market=a.market, changed_files=a.changed_files, symbols=_merged(a.test_symbols), months=_merged(a.test_months), max_tasks=a.max_tasks, plan_only=a.plan_only, overwrite=a.overwrite), 0
    if a.command == "ingest-local-downloads-to-lake":
        kinds, out = [d for d in DATASETS if getattr(a, d)], {"ok": True, "timeframes": {}}
        for n, tf in enumerate(_merged(a.timeframes)):  # funding has no timeframe and is read once
            own = kinds if not n else [d for d in kinds if d != "funding"]
            out["timeframes"][tf] = one = api.ingest_local_downloads_to_lake(spark, a.downloads, a.root, start_date=a.startdate, end_date=a.enddate, datasets=own, symbols=symbols, timeframe=tf, market=a.market, done=a.done)
            out["ok"] = out["ok"] and one["ok"]
        return out, 0
    if a.command == "fetch-futures":
        return api.fetch_futures(
            spark, a.out_root, symbols, a.datatype, get=_client(a.url), timeframe=a.timeframe, start_date=a.start_date, end_date=a.end_date, days_back=a.days,
            retries=a.retries, backoff_s=a.backoff_s, timeout=tuple(a.timeout), sleep_s=a.sleep_s, dry_run=a.dry_run,
        ), 0
    more = {"symbols": symbols, "output_dir": a.output_dir, "market": a.market}
    if a.check == "metadata":
        run = v.validate_metadata(spark, a.root, a.meta_root, profile=a.profile, datasets=a.datasets, timeframe=a.timeframe_filter, **dates, **more)
    elif a.check == "derived-1d":
        run = v.validate_derived_1d(spark, a.root, dataset=a.dataset, months=_merged(a.months, a.month), sample_limit=a.sample_limit, tolerance=a.tolerance, **dates, **more)
    else:
        run = v.validate_all(spark, a.root, a.meta_root, profile=a.profile, datasets=a.derived_datasets, append_date_start=a.append_date_start, append_date_end=a.append_date_end, candidate_rank_threshold=a.candidate_rank_threshold, sample_limit=a.sample_limit, **more)
    return run.to_dict(), v.exit_code(run.status)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    from tidemark.session import session

    out, code = dispatch(a, session())
    print(json.dumps(out, indent=2, default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
