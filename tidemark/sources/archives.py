"""ZIP archives of CSV files: listing, checking, reading on the executors."""

from __future__ import annotations

import glob
import io
import os
import time
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.exprs import days, month_starts
from tidemark.schemas import SPECS
from tidemark.sources.lake import Scope
from tidemark.sources.paths import day_of_key

GRACE_S = 600
PARTIAL = (".part", ".tmp", ".download")
DELIMITERS = ",\t;|"
#: Fields an archive's header must have; klines have none that are checked.
REQUIRED = {"klines": (), "mark": ("open", "high", "low", "close"), "index": ("open", "high", "low", "close"), "funding": ("symbol", "time", "fundingRate")}
FIELDS = {
    "klines": ("time", "open", "high", "low", "close", "volume"),
    "mark": ("time", "open", "high", "low", "close"),
    "index": ("time", "open", "high", "low", "close"),
    "funding": ("symbol", "time", "fundingRate"),
}


def download_root(root: str) -> str:
    """The folder that holds the datasets' folders, searched for below ``root``."""
    for tail in ("", "data/futures/daily", "futures/daily", "daily", "data"):
        path = os.path.join(root, tail)
        if any(os.path.isdir(os.path.join(path, s.remote_dir)) for s in SPECS.values()):
            return path
    raise FileNotFoundError(f"no dataset folder under {root}")


def in_flight(path: str, now: float | None = None) -> bool:
    """Whether a file is still being written: by its name, or changed within the grace time."""
    return path.endswith(PARTIAL) or (now or time.time()) - os.path.getmtime(path) < GRACE_S


def zip_is_valid(file: str | io.BytesIO) -> bool:
    """Whether a ZIP, a path or its content, is whole and its sums are right."""
    try:
        with zipfile.ZipFile(file) as z:
            return z.testzip() is None
    except (OSError, zipfile.BadZipFile, zlib.error):
        return False


def list_archives(root: str, dataset: str, scope: Scope, timeframe: str = "1m") -> list[tuple[str, str, str]]:
    """(path, symbol, day) of archives in scope; months narrow the globs, days are exact."""
    spec, found = SPECS[dataset], []
    if not scope.start or not scope.end:
        raise ValueError("both ends of the days are needed")
    wanted = {f"{d:%Y-%m-%d}" for d in days(scope.start, scope.end)}
    base = os.path.join(root, spec.remote_dir)
    symbols = scope.symbols or sorted(os.listdir(base) if os.path.isdir(base) else [])
    for symbol in symbols:
        folder = os.path.join(base, symbol, timeframe) if spec.has_timeframe else os.path.join(base, symbol)
        for month in month_starts(scope.start, scope.end):
            for path in glob.glob(os.path.join(glob.escape(folder), f"*-{month:%Y-%m}-??.zip")):
                day = day_of_key(path)
                if day and f"{day:%Y-%m-%d}" in wanted:
                    found.append((path, symbol, f"{day:%Y-%m-%d}"))
    return sorted(set(found))


def read_csv_member(content: bytes, dataset: str) -> pd.DataFrame:
    """Text columns of the one CSV inside an archive."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(".csv")]
        if len(names) != 1:
            raise ValueError(f"{len(names)} CSV files in the archive")
        text = z.read(names[0]).decode("utf-8-sig")
    header = text.split("\n", 1)[0].strip("\r")
    delimiter = max(DELIMITERS, key=header.count) if dataset == "funding" else ","
    fields = [f.strip() for f in header.split(delimiter)]
    missing = [f for f in REQUIRED[dataset] if f not in fields]
    if missing:
        raise ValueError(f"header lacks {missing}")
    if dataset == "klines" and "time" not in fields:  # taken by place
        fields = list(FIELDS[dataset])[: len(fields)]
    df = pd.read_csv(io.StringIO(text), sep=delimiter, header=0, names=fields, dtype=str, quoting=3, skip_blank_lines=True)
    for f in FIELDS[dataset]:
        if f not in df:
            df[f] = None
    return df[list(FIELDS[dataset])]


#: How the error of an archive that is no sound ZIP begins.
INVALID = "invalid zip"


def read_archives(spark: SparkSession, listed: list[tuple[str, str, str]], dataset: str, check: bool = True) -> DataFrame:
    """Text rows with ``path``, ``lake_symbol``, ``lake_date`` and ``error``; an archive that fails gives one row with the error.

    Archives can't be split: one is one record of a task, which also checks all its sums if
    ``check``. The paths must be ones that every executor sees.
    """
    schema = ", ".join(["path string", "lake_symbol string", "lake_date string", "error string", *(f"`{f}` string" for f in FIELDS[dataset])])
    files = spark.createDataFrame(listed, "path string, lake_symbol string, lake_date string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, symbol, day in batch.itertuples(index=False):
                about = {"path": path, "lake_symbol": symbol, "lake_date": day}
                try:
                    with open(path, "rb") as f:
                        content = f.read()
                    if check and not zip_is_valid(io.BytesIO(content)):
                        raise zipfile.BadZipFile(path)
                    rows = read_csv_member(content, dataset)
                    yield rows.assign(**about, error=None)[[*about, "error", *FIELDS[dataset]]]
                except Exception as e:
                    what = INVALID if isinstance(e, zipfile.BadZipFile) else type(e).__name__
                    yield pd.DataFrame([about | {"error": f"{what}: {e}"} | dict.fromkeys(FIELDS[dataset])])

    return files.repartition(max(1, min(len(listed), 4 * spark.sparkContext.defaultParallelism))).mapInPandas(run, schema)
