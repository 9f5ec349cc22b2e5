"""Column expressions with the semantics the operators share."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTES = {"m": 1, "h": 60, "d": 1440}
#: Names a column may go by, in order of preference.
ALIASES = {
    "time": ("ts", "timestamp", "time", "max_ts", "min_ts", "date", "day"),
    "open": ("open", "o"),
    "high": ("high", "h"),
    "low": ("low", "l"),
    "close": ("close", "c"),
    "volume": ("volume", "vol", "qty", "size", "base_volume"),
}
DAY_ALIASES = ("date", "ts", "day")


def timeframe_minutes(timeframe: str) -> int:
    m = re.fullmatch(r"(\d+)([mhd])", timeframe)
    if not m or not int(m[1]):
        raise ValueError(f"unknown timeframe: {timeframe!r}")
    return int(m[1]) * MINUTES[m[2]]


def expected_rows(timeframe: str) -> int | None:
    """Rows of a full day, None where the timeframe does not divide it."""
    try:
        minutes = timeframe_minutes(timeframe)
    except ValueError:
        return None
    return 1440 // minutes if 1440 % minutes == 0 else None


def normalize_symbol(symbol: str) -> str:
    return "BTC" + symbol[3:] if symbol.startswith("XBT") else symbol


def as_date(value: date | str | None, name: str = "date") -> date | None:
    if value is None or type(value) is date:
        return value
    if isinstance(value, date):
        return value.date()
    try:
        return date.fromisoformat(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} is not YYYY-MM-DD: {value!r}") from None


def days(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def month_starts(start: date, end: date) -> list[date]:
    out, at = [], start.replace(day=1)
    while at <= end:
        out.append(at)
        at = (at + timedelta(days=31)).replace(day=1)
    return out


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` that stands for ``name``, whatever its letter case."""
    there = {c.lower(): c for c in df.columns}
    for alias in ALIASES[name]:
        if alias in there:
            return there[alias]
    raise ValueError(f"no {name} column among {sorted(there)}")


def day_key(df: DataFrame) -> Column:
    there = {c.lower(): c for c in df.columns}
    for alias in DAY_ALIASES:
        if alias in there:
            return F.to_date(there[alias])
    raise ValueError(f"no day column among {sorted(there)}")


def first_by(value: str | Column, *order: str) -> Column:
    """The first value that is not null; the order must be total to be repeatable."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min(F.when(v.isNotNull(), F.struct(*order, v.alias("_v")))).getField("_v")


def last_by(value: str | Column, *order: str) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(v.isNotNull(), F.struct(*order, v.alias("_v")))).getField("_v")


def vwap(price: str = "close", volume: str = "volume") -> Column:
    total = F.sum(volume)
    return F.when(total != 0, F.sum(F.col(price) * F.col(volume)) / total)


def differs(a: Column, b: Column, numeric: bool, tolerance: float = 1e-12) -> Column:
    """Null-safe difference; numbers within the tolerance are equal."""
    if not numeric:
        return ~a.eqNullSafe(b)
    return (a.isNull() != b.isNull()) | F.coalesce((F.abs(a - b) > tolerance) | (F.isnan(a.cast("double")) != F.isnan(b.cast("double"))), F.lit(False))


def names_where(flags: dict[str, Column]) -> Column:
    """Names whose flag is true, joined by commas."""
    return F.concat_ws(",", *(F.when(flag, F.lit(name)) for name, flag in flags.items()))


def epoch_ms(text: Column) -> Column:
    """Whole milliseconds from digits or scientific notation, rounded half to even."""
    return F.rint(text.cast("double")).cast("long")


def funding_scope(timeframe: str) -> Column:
    """Rows of a build's timeframe; funding, which has none, belongs to one-minute builds."""
    own = F.col("timeframe") == timeframe
    return own | ((F.col("dataset") == "funding") & (F.col("timeframe") == "")) if timeframe == "1m" else own
