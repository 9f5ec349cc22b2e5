"""Registered queries over the driver's tables, each with its SQL counterpart.

No table of bars exists there, so ticks are events: the user is the symbol, the
value the price. Event types stand for datasets, orders for daily flows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import archives, bars, checks, coverage, integrity, liquidity, panel, selectors, tables, universe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


#: Columns returned as text, so that both engines hand them over alike: days, and what may be null.
_AS_TEXT = {
    "bars_1d": "date", "bars_1d_prices": "date", "coverage_day": "date expected_rows is_suspect", "coverage_partial_final": "date", "symbol_stats": "min_date max_date",
    "alignment_pivot": "date", "integrity_day": "date", "liquidity_base": "date", "rolling_median_rank": "date", "rolling_rank_range": "date", "rolling_rank_long": "date",
    "rolling_rank_keys": "date", "topn_by_rank": "date", "missing_keys_anti": "date", "semi_in_dates": "date", "update_from_ranked": "date liquidity_rank_30d",
    "candidate_ranks_d1": "day asof_date", "hysteresis_members": "day asof_date", "universe_all_candidates": "day asof_date", "universe_turnover": "day",
    "exact_day_returns": "day", "base_panel": "day asof_date src_rows", "panel_summary": "day", "ratio_bounds_violations": "date",
    "alignment_backed_by_coverage": "date", "liquidity_backed_by_coverage": "date", "fingerprint": "hash_sum",
}


def _register(sql: str):
    def put(f):
        texts = _AS_TEXT.get(f.__name__, "").split()

        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c in texts}) if texts else df

        query.__name__, query.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = query
        casts = ", ".join(f"cast({c} as varchar) as {c}" for c in texts)
        ORACLE_SQL[f.__name__] = f"select * replace ({casts}) from ({sql})" if texts else sql
        return f

    return put


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded as the SQL's engine does it: scaled, rounded to a whole number, scaled back.

    F.round goes by the shortest decimal of a double instead, which takes 97.46906249999999 down where the scaled number is 97469062.5.
    """
    scale = F.lit(10.0**digits)
    return df.select(*(F.when(F.abs(F.col(c)) < 1e300, F.round(F.col(c) * scale, 0) / scale).otherwise(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


# ---------------------------------------------------------------- inputs


#: Where a row is stored: the SQL's engine adds rows in this order (on one thread; on more, its sums vary from run to run).
_STORED = {"_file": "_metadata.file_path", "_row": "_metadata.row_index"}


def _ticks(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", "cast(user_id as string) as symbol", "event_type", "ts", "cast(ts as date) as date", "value as open",
        "value + event_id % 3 as high", "value - event_id % 2 as low", "value as close", "cast(event_id % 7 + 1 as double) as volume",
        *(f"{x} as {c}" for c, x in _STORED.items() if stored),
    )


_TICKS = """ticks as (select event_id, cast(user_id as varchar) as symbol, event_type, ts, cast(ts as date) as date, value as open,
  value + event_id % 3 as high, value - event_id % 2 as low, value as close, cast(event_id % 7 + 1 as double) as volume from events)"""


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage with event types for datasets; funding has neither timeframe nor expected rows."""
    rows = _ticks(spark, sf_dir).withColumn("dataset", F.expr("case event_type when 'click' then 'klines' when 'view' then 'mark' when 'purchase' then 'index' when 'signup' then 'funding' end"))
    rows = rows.where("dataset is not null").withColumn("market", F.lit("futures"))
    keys = ["market", "dataset", "symbol", "date", "timeframe"]
    core = coverage.coverage(rows.where("dataset <> 'funding'").withColumn("timeframe", F.lit("1h")).withColumn("file", F.col("event_id") % 2), keys, "1h", threshold=0.05)
    funding = coverage.coverage(rows.where("dataset = 'funding'").withColumn("timeframe", F.lit("")).withColumn("file", F.col("event_id") % 2), keys, None)
    # built as one-minute rows, so that funding takes part
    return core.unionByName(funding).withColumn("timeframe", F.when(F.col("dataset") == "funding", "").otherwise("1m"))


_COVERED = (
    _TICKS
    + """, covered as (
  select 'futures' as market, dataset, symbol, date, case when dataset = 'funding' then '' else '1m' end as timeframe,
    count(distinct event_id % 2) as num_files, count(*) as num_rows, count(distinct date_trunc('minute', ts)) as distinct_minute_cnt,
    min(ts) as min_ts, max(ts) as max_ts, case when dataset <> 'funding' then 24 end as expected_rows,
    case when dataset <> 'funding' then count(*) / 24.0::double end as completeness_ratio,
    case when dataset <> 'funding' then count(*) / 24.0::double < 0.05 end as is_suspect
  from (select *, case event_type when 'click' then 'klines' when 'view' then 'mark' when 'purchase' then 'index' when 'signup' then 'funding' end as dataset from ticks)
  where dataset is not null group by dataset, symbol, date)"""
)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["symbol", "date"]
    base = _round(liquidity.daily_base(_ticks(spark, sf_dir), keys, ["event_id"]))
    return base.select(F.lit("futures").alias("market"), F.lit("1m").alias("timeframe"), "*")


_BASE = (
    _TICKS
    + """, base as (select 'futures' as market, '1m' as timeframe, symbol, date, round(sum(close * volume), 6) as dollar_volume,
  round(sum(volume), 6) as volume, round(last(close order by ts, event_id), 6) as close_price from ticks group by symbol, date)"""
)


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return liquidity.rolling_rank(_base(spark, sf_dir), top=40, digits=6)


_RANKED = (
    _BASE
    + """, med as (select *, round(quantile_cont(dollar_volume, 0.5) over (partition by market, timeframe, symbol order by date rows between 29 preceding and current row), 6) as dv_30d_median from base),
ranked as (select *, cast(rank() over (partition by market, timeframe, date order by dv_30d_median desc nulls last) as integer) as liquidity_rank_30d from med),
liq as (select *, liquidity_rank_30d <= 40 as in_top_100 from ranked)"""
)

_LIQ_COLUMNS = "market, timeframe, symbol, date, dollar_volume, volume, close_price, dv_30d_median, liquidity_rank_30d, in_top_100"

# ---------------------------------------------------------------- raw rows and bars


@_register("""select event_id, user_id as id, cast(event_id * 60000 + 1700000000000 as bigint) as time_ms,
  make_timestamp((event_id * 60000 + 1700000000000) * 1000) as ts, value as open, value + 1 as high, value - 1 as low, value as close, cast(event_id % 5 as double) as volume from events""")
def raw_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", "user_id as id", "cast(cast(event_id * 60000 + 1700000000000 as double) as string) as time", "cast(value as string) as open", "cast(value + 1 as string) as high",
        "cast(value - 1 as string) as low", "cast(value as string) as close", "cast(event_id % 5 as string) as volume",
    )
    return archives.normalize_bars(raw).withColumn("ts", F.expr("timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, time_ms / 1000.0)"))


_BARS_1D = """symbol, date, round(first(open order by ts, event_id), 6) as open, round(max(high), 6) as high, round(min(low), 6) as low,
  round(last(close order by ts, event_id), 6) as close, round(sum(volume), 6) as volume, round(sum(close * volume), 6) as dollar_volume,
  round(sum(close * volume) / sum(volume), 6) as vwap, count(*) as src_rows, min(ts) as min_ts, max(ts) as max_ts from ticks group by symbol, date"""


@_register(f"with {_TICKS} select {_BARS_1D}")
def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(bars.daily_bars(_ticks(spark, sf_dir, stored=True), ["symbol", "date"], ["event_id"], in_order=list(_STORED)))


@_register(f"""with {_TICKS} select event_type as symbol, date, round(first(open order by ts, event_id), 6) as open, round(max(high), 6) as high, round(min(low), 6) as low,
  round(last(close order by ts, event_id), 6) as close, count(*) as src_rows, min(ts) as min_ts, max(ts) as max_ts from ticks group by event_type, date""")
def bars_1d_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _ticks(spark, sf_dir).drop("symbol").withColumnRenamed("event_type", "symbol")
    return _round(bars.daily_bars(ticks, ["symbol", "date"], ["event_id"], volume=False))


@_register("""select distinct cast(o_custkey as varchar) as symbol, strftime(o_orderdate, '%Y-%m') as month from orders""")
def resample_plan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.months_to_resample(spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("cast(o_custkey as string) as symbol", "cast(o_orderdate as date) as date"))


@_register("""select distinct o_orderpriority as symbol, strftime(o_orderdate, '%Y-%m') as month from orders where o_orderpriority in ('1-URGENT', '2-HIGH') order by 1, 2 limit 20""")
def resample_plan_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderpriority as symbol", "cast(o_orderdate as date) as date")
    return bars.months_to_resample(parts, symbols=["1-URGENT", "2-HIGH"], max_tasks=20)


# ---------------------------------------------------------------- coverage


@_register(f"""with {_COVERED} select market, dataset, symbol, date, timeframe, num_files, num_rows, distinct_minute_cnt, min_ts, max_ts, expected_rows,
  round(completeness_ratio, 6) as completeness_ratio, is_suspect from covered""")
def coverage_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_covered(spark, sf_dir))


@_register(f"""with {_TICKS} select symbol, date, cast(count(distinct event_id % 4) as bigint) as num_files, count(*) as num_rows,
  cast(sum(mins) as bigint) as distinct_minute_cnt, min(ts) as min_ts, max(ts) as max_ts, 24 as expected_rows, round(count(*) / 24.0::double, 6) as completeness_ratio, count(*) / 24.0::double < 0.98 as is_suspect
  from (select *, case when row_number() over (partition by symbol, date, event_id % 4, date_trunc('minute', ts) order by event_id) = 1 then 1 else 0 end as mins from ticks) group by symbol, date""")
def coverage_partial_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ticks(spark, sf_dir).withColumn("file", F.col("event_id") % 4)
    parts = coverage.coverage(rows, ["symbol", "date", "file"], "1h")
    return _round(coverage.merge_partial(parts, ["symbol", "date"]))


@_register(f"""with {_COVERED} select market, dataset, symbol, case when dataset = 'funding' and timeframe = '' then '1m' else timeframe end as timeframe,
  min(date) as min_date, max(date) as max_date, min(min_ts) as min_ts, max(max_ts) as max_ts, count(*) as days_present,
  cast(count(*) filter (not coalesce(is_suspect, false)) as bigint) as days_complete, round(avg(case when is_suspect is not null then (not is_suspect)::int end), 6) as pct_days_complete,
  round(avg(num_rows), 6) as avg_rows_per_day from covered where timeframe = '1m' or dataset = 'funding' and timeframe = '' group by market, dataset, symbol, timeframe""")
def symbol_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(coverage.symbol_stats(_covered(spark, sf_dir), "1m"))


_ALIGNED = """select market, symbol, date, '1m' as timeframe, bool_or(dataset = 'klines') as has_klines, bool_or(dataset = 'mark') as has_mark, bool_or(dataset = 'index') as has_index,
  bool_or(dataset = 'funding') as has_funding, min(case when dataset in ('klines', 'mark', 'index') then completeness_ratio end) as core_completeness_min from covered group by market, symbol, date"""


@_register(f"""with {_COVERED}, al as ({_ALIGNED}) select market, symbol, date, timeframe, has_klines, has_mark, has_index, has_funding, round(core_completeness_min, 6) as core_completeness_min,
  has_klines and has_mark and has_index as all_core_present,
  trim(case when has_klines then '' else 'klines,' end || case when has_mark then '' else 'mark,' end || case when has_index then '' else 'index' end, ',') as core_missing_mask from al""")
def alignment_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(coverage.alignment(_covered(spark, sf_dir), "1m"))


# ---------------------------------------------------------------- integrity and liquidity


@_register(f"""with {_TICKS}, w as (select *, lag(close) over (partition by symbol, date order by ts, event_id) as prev from ticks)
select symbol, date, count(*) as num_rows, count(distinct date_trunc('minute', ts)) as distinct_minute_cnt, 1440 - count(distinct date_trunc('minute', ts)) as gap_rows_vs_expected,
  count(*) - count(distinct date_trunc('minute', ts)) as duplicate_rows, cast(count(*) filter (high < low) as bigint) as high_lt_low_cnt,
  cast(count(*) filter (open <= 0 or high <= 0 or low <= 0 or close <= 0) as bigint) as nonpositive_price_cnt, round(max(abs(close / nullif(prev, 0) - 1)), 6) as max_abs_ret_1m from w group by symbol, date""")
def integrity_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(integrity.integrity(_ticks(spark, sf_dir), ["symbol", "date"], ["event_id"]))


@_register(f"with {_BASE} select * from base")
def liquidity_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir)


@_register(f"with {_RANKED} select {_LIQ_COLUMNS} from liq")
def rolling_median_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)


@_register(f"with {_RANKED} select market, timeframe, symbol, date, dv_30d_median, liquidity_rank_30d from liq where date between date '2024-01-15' and date '2024-01-20'")
def rolling_rank_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    ranged = liquidity.with_rank(_round(liquidity.rolling_rank_in_range(base, F.lit("2024-01-15").cast("date"), F.lit("2024-01-20").cast("date")).drop("liquidity_rank_30d", "in_top_100")))
    return ranged.select("market", "timeframe", "symbol", "date", "dv_30d_median", "liquidity_rank_30d")


_LINES = """flow as (select 'futures' as market, '1d' as timeframe, cast(l_suppkey as varchar) as symbol, cast(l_shipdate as date) as date, round(sum(l_extendedprice), 4) as dollar_volume from lineitem group by l_suppkey, cast(l_shipdate as date))"""


@_register(f"""with {_LINES}, med as (select *, round(quantile_cont(dollar_volume, 0.5) over (partition by symbol order by date rows between 29 preceding and current row), 4) as dv_30d_median from flow)
select *, cast(rank() over (partition by date order by dv_30d_median desc nulls last) as integer) as liquidity_rank_30d, rank() over (partition by date order by dv_30d_median desc nulls last) <= 100 as in_top_100 from med""")
def rolling_rank_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of gappy days to a series."""
    flow = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(F.round(F.sum("l_extendedprice"), 4).alias("dollar_volume"))
    return liquidity.rolling_rank(flow.select(F.lit("futures").alias("market"), F.lit("1d").alias("timeframe"), "*"), digits=4)


@_register(f"with {_RANKED} select market, timeframe, symbol, date, dv_30d_median, liquidity_rank_30d, in_top_100 from liq where date in (select date from liq where symbol = '7' and date >= date '2024-01-20')")
def rolling_rank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    keys = base.where("symbol = '7' and date >= date '2024-01-20'")
    out = liquidity.rolling_rank_for_keys(base, keys, top=40).drop("liquidity_rank_30d", "in_top_100")
    return liquidity.with_rank(_round(out), top=40).select("market", "timeframe", "symbol", "date", "dv_30d_median", "liquidity_rank_30d", "in_top_100")


@_register(f"with {_RANKED} select date, symbol, liquidity_rank_30d from liq where liquidity_rank_30d <= 10")
def topn_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).where("liquidity_rank_30d <= 10").select("date", "symbol", "liquidity_rank_30d")


# ---------------------------------------------------------------- joins and table changes


@_register(f"""with {_RANKED}, {_COVERED[len(_TICKS) + 2:]} select c.market, c.symbol, c.date, c.timeframe from covered c
  where dataset = 'klines' and not exists (select 1 from liq l where l.market = c.market and l.symbol = c.symbol and l.date = c.date and l.timeframe = c.timeframe and l.in_top_100)""")
def missing_keys_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing_keys(_covered(spark, sf_dir), _ranked(spark, sf_dir).where("in_top_100"), "1m")


_FILES = "select cast(o_orderkey as varchar) as file_rel, cast(floor(o_totalprice) as bigint) as file_size_bytes, cast(o_custkey as bigint) as mtime_ns from orders"


@_register(f"""with f as ({_FILES}), k as (select file_rel, file_size_bytes + (case when cast(file_rel as bigint) % 7 = 0 then 1 else 0 end) as s, mtime_ns + (case when cast(file_rel as bigint) % 11 = 0 then 1 else 0 end) as m from f where cast(file_rel as bigint) % 5 <> 0)
select f.* from f left join k using (file_rel) where k.s is null or k.s <> f.file_size_bytes or k.m <> f.mtime_ns""")
def manifest_diff_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("cast(o_orderkey as string) as file_rel", "cast(floor(o_totalprice) as long) as file_size_bytes", "o_custkey as mtime_ns")
    n = "cast(file_rel as long)"
    known = now.where(f"{n} % 5 <> 0").selectExpr("file_rel", f"file_size_bytes + if({n} % 7 = 0, 1, 0) as file_size_bytes", f"mtime_ns + if({n} % 11 = 0, 1, 0) as mtime_ns")
    return archives.changed_files(now, known)


@_register(f"with {_BASE} select symbol, date, dollar_volume from base where date in (select cast(o_orderdate + interval 30 years as date) from orders union select date '2024-01-02') ")
def semi_in_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.add_months(F.to_date("o_orderdate"), 360).alias("date")).union(spark.sql("select date '2024-01-02'"))
    return _base(spark, sf_dir).join(days.distinct(), "date", "left_semi").select("symbol", "date", "dollar_volume")


_HALVES = """o as (select o_orderkey as k, o_totalprice as v, o_orderpriority as w from orders where o_orderkey % 3 <> 0), n as (select o_orderkey as k, o_totalprice + 1 as v, 'new' as w from orders where o_orderkey % 2 = 0)"""


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return t.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey as k", "o_totalprice as v", "o_orderpriority as w"), t.where("o_orderkey % 2 = 0").selectExpr("o_orderkey as k", "o_totalprice + 1 as v", "'new' as w")


@_register(f"with {_HALVES} select k, round(v, 4) as v, w from n union all select k, round(v, 4), w from o where k not in (select k from n)")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(tables.upsert(*_halves(spark, sf_dir), ["k"]), 4)


@_register(f"with {_HALVES} select coalesce(n.k, o.k) as k, round(coalesce(n.v, o.v), 4) as v, coalesce(o.w, n.w) as w from o full join n on o.k = n.k")
def merge_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(tables.upsert(*_halves(spark, sf_dir), ["k"], keep=["w"]), 4)


@_register(f"with {_HALVES} select k, round(v, 4) as v, w from o where not (w = '1-URGENT' or k < 1000) union all select k, round(v, 4), w from n where k < 1000")
def scoped_delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, n = _halves(spark, sf_dir)
    return _round(tables.replace_where(o, n.where("k < 1000"), (F.col("w") == "1-URGENT") | (F.col("k") < 1000)), 4)


@_register(f"with {_HALVES} select k, round(v, 4) as v, w from o where k not in (select k from n where k % 4 = 0) union all select k, round(v, 4), w from n where k % 4 = 0")
def replace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, n = _halves(spark, sf_dir)
    return _round(tables.replace_keys(o, n.where("k % 4 = 0"), ["k"]), 4)


@_register(f"""with {_RANKED} select b.market, b.timeframe, b.symbol, b.date, b.dollar_volume, l.dv_30d_median, l.liquidity_rank_30d from base b left join (select * from liq where date >= date '2024-01-25') l using (market, timeframe, symbol, date)""")
def update_from_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["market", "timeframe", "symbol", "date"]
    fresh = _ranked(spark, sf_dir).where("date >= date '2024-01-25'").select(*keys, "dv_30d_median", "liquidity_rank_30d")
    return tables.update_from(_base(spark, sf_dir).select(*keys, "dollar_volume"), fresh, keys, ["dv_30d_median", "liquidity_rank_30d"])


@_register("""with req as (select distinct o_custkey as symbol, strftime(o_orderdate, '%Y-%m-%d') as day from orders), listed as (select * from req where symbol % 3 <> 0), loc as (select * from req where symbol % 5 = 0)
select * from req where exists (select 1 from listed l where l.symbol = req.symbol and l.day = req.day) and not exists (select 1 from loc l where l.symbol = req.symbol and l.day = req.day)""")
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("symbol"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    return archives.download_plan(req, req.where("symbol % 3 <> 0"), req.where("symbol % 5 = 0"), ["symbol", "day"])


# ---------------------------------------------------------------- selectors and universe


@_register(f"with {_RANKED} select symbol, count(*) as days from liq where liquidity_rank_30d <= 30 and date between date '2024-01-05' and date '2024-01-25' group by symbol having count(*) >= 3")
def candidate_superset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selectors.candidate_superset(_ranked(spark, sf_dir), 30, "2024-01-05", "2024-01-25", min_days=3)


@_register(f"with {_RANKED} select symbol, count(*) as days from liq where liquidity_rank_30d between 30 and 50 and date > (select max(date) from liq) - 14 group by symbol having count(*) >= 2")
def near_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selectors.near_threshold(_ranked(spark, sf_dir), 40, 10, min_days=2)


_CANDIDATES = (
    _RANKED
    + """, cand as (select date + 1 as day, date as asof_date, symbol, dv_30d_median as asof_dv_30d_median, liquidity_rank_30d as asof_liquidity_rank_30d, dollar_volume as asof_dollar_volume,
  volume as asof_volume, close_price as asof_close_price from liq where date + 1 between date '2024-01-03' and date '2024-01-28')"""
)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.candidate_ranks(_ranked(spark, sf_dir), "2024-01-03", "2024-01-28")


@_register(f"with {_CANDIDATES} select * from cand")
def candidate_ranks_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


_MEMBERS = (
    _CANDIDATES
    + """, days as (select day, row_number() over (order by day) as i from (select distinct day from cand)),
sig as (select cand.*, i, case when asof_liquidity_rank_30d <= 30 then true when asof_liquidity_rank_30d > 45 then false end as s from cand join days using (day)),
runs as (select *, i - row_number() over (partition by symbol order by i) as run from sig),
state as (select *, coalesce(last_value(s ignore nulls) over (partition by symbol, run order by i rows between unbounded preceding and current row), false) as inside from runs),
members as (select day, symbol, asof_date, asof_dv_30d_median, asof_liquidity_rank_30d, asof_dollar_volume, asof_volume, asof_close_price, 30 as entry_n, 45 as exit_n, isodow(day) >= 6 as is_weekend from state where inside)"""
)


@_register(f"with {_MEMBERS} select * from members")
def hysteresis_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.hysteresis(_candidates(spark, sf_dir), 30, 45).select(*universe.COLUMNS)


def _all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.universe_daily(_ranked(spark, sf_dir), "2024-01-03", "2024-01-28", 30, 45, all_candidates=True)


_ALL = _MEMBERS + """, uni as (select cand.*, 30 as entry_n, 45 as exit_n, isodow(cand.day) >= 6 as is_weekend, m.symbol is not null as in_universe from cand left join members m on m.day = cand.day and m.symbol = cand.symbol)"""


@_register(f"with {_ALL} select * from uni")
def universe_all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_candidates(spark, sf_dir)


@_register(f"""with {_ALL}, c as (select day, count(*) as n_members, row_number() over (order by day) as j from members group by day),
a as (select m.day, count(*) filter (not exists (select 1 from members p join c cp on cp.day = p.day where p.symbol = m.symbol and cp.j = c.j - 1)) as adds from members m join c on c.day = m.day group by m.day),
t as (select c.day, c.n_members, a.adds, p.n_members as before from c join a on a.day = c.day left join c p on p.j = c.j - 1)
select day, n_members, cast(adds as bigint) as adds, cast(coalesce(before - n_members + adds, 0) as bigint) as drops, round(case when before is null then 0.0::double else (adds + before - n_members + adds) / before::double end, 6) as turnover_rate,
  (select count(*) from uni where uni.day = t.day) as candidate_count from t""")
def universe_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(universe.turnover(_all_candidates(spark, sf_dir)))


# ---------------------------------------------------------------- panel


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_1d(spark, sf_dir).withColumnRenamed("date", "day")


_RETURNS = f"""bars as (select {_BARS_1D}),
rets as (select b.symbol, b.date as day, b.open, b.high, b.low, b.close, b.volume, b.dollar_volume, b.vwap, b.src_rows, b.max_ts, b.close / nullif(m1.close, 0) - 1 as ret_1d, p1.close / nullif(b.close, 0) - 1 as fwd_ret_1d,
  p5.close / nullif(b.close, 0) - 1 as fwd_ret_5d, p20.close / nullif(b.close, 0) - 1 as fwd_ret_20d,
  case when b.close > 0 and m1.close > 0 then ln(b.close) - ln(m1.close) end as log_ret_1d, case when b.close > 0 and p1.close > 0 then ln(p1.close) - ln(b.close) end as fwd_log_ret_1d
  from bars b left join bars m1 on m1.symbol = b.symbol and m1.date = b.date - 1 left join bars p1 on p1.symbol = b.symbol and p1.date = b.date + 1
  left join bars p5 on p5.symbol = b.symbol and p5.date = b.date + 5 left join bars p20 on p20.symbol = b.symbol and p20.date = b.date + 20)"""
_RET_COLUMNS = ", ".join(f"round({c}, 6) as {c}" for c in ("ret_1d", "fwd_ret_1d", "fwd_ret_5d", "fwd_ret_20d", "log_ret_1d", "fwd_log_ret_1d"))


@_register(f"with {_TICKS}, {_RETURNS} select symbol, day, close, {_RET_COLUMNS} from rets")
def exact_day_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel.exact_day_returns(_bars(spark, sf_dir), check=False)  # grouped by symbol and day
    return _round(rows.select("symbol", "day", "close", "ret_1d", "fwd_ret_1d", "fwd_ret_5d", "fwd_ret_20d", "log_ret_1d", "fwd_log_ret_1d"))


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.base_panel(_all_candidates(spark, sf_dir), _bars(spark, sf_dir))


_PANEL = (
    _ALL
    + f""", {_RETURNS}, pan as (select u.day, u.symbol, asof_date, is_weekend, asof_dv_30d_median, asof_liquidity_rank_30d, asof_dollar_volume, asof_volume, asof_close_price, open, high, low, close, volume, dollar_volume,
  case when dollar_volume is not null then ln(greatest(dollar_volume, 1.0)) end as log_dollar_volume, vwap, src_rows, max_ts, ret_1d, fwd_ret_1d, fwd_ret_5d, fwd_ret_20d, log_ret_1d, fwd_log_ret_1d, entry_n, exit_n
  from (select * from uni where in_universe) u left join rets r on r.day = u.day and r.symbol = u.symbol)"""
)


@_register(f"with {_PANEL} select * replace ({_RET_COLUMNS}, round(log_dollar_volume, 6) as log_dollar_volume) from pan")
def base_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_panel(spark, sf_dir))


@_register(f"""with {_PANEL} select day, count(distinct symbol) as n_symbols, round(avg(ret_1d), 6) as mean_ret_1d, round(avg(fwd_ret_1d), 6) as mean_fwd_ret_1d, round(avg(fwd_ret_5d), 6) as mean_fwd_ret_5d,
  round(avg(fwd_ret_20d), 6) as mean_fwd_ret_20d, round(avg((close is null)::int), 6) as missing_close_pct, round(avg((fwd_ret_1d is null)::int), 6) as missing_fwd_ret_1d_pct from pan group by day""")
def panel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(panel.panel_summary(_panel(spark, sf_dir)))


# ---------------------------------------------------------------- validation


_SIDES = """e as (select o_orderkey as k, o_totalprice as v, o_orderpriority as w from orders where o_orderkey % 10 <> 0), a as (select o_orderkey as k, o_totalprice + (case when o_orderkey % 7 = 0 then 0.5 else 0 end) as v, case when o_orderkey % 9 = 0 then null else o_orderpriority end as w from orders where o_orderkey % 11 <> 0)"""


@_register(f"""with {_SIDES} select coalesce(e.k, a.k) as k, case when a.k is null then 'left_only' when e.k is null then 'right_only' else 'both' end as side,
  trim(case when e.k is not null and a.k is not null and (e.v is null) <> (a.v is null) or abs(e.v - a.v) > 1e-12 then 'v,' else '' end || case when e.k is not null and a.k is not null and e.w is distinct from a.w then 'w' else '' end, ',') as mismatch
  from e full join a on e.k = a.k""")
def outer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.read.parquet(f"{sf_dir}/orders.parquet")
    e = t.where("o_orderkey % 10 <> 0").selectExpr("o_orderkey as k", "o_totalprice as v", "o_orderpriority as w")
    a = t.where("o_orderkey % 11 <> 0").selectExpr("o_orderkey as k", "o_totalprice + if(o_orderkey % 7 = 0, 0.5D, 0D) as v", "if(o_orderkey % 9 = 0, null, o_orderpriority) as w")
    return tables.compare(e, a, ["k"], ["v", "w"]).select("k", "side", "mismatch")


@_register("""with a as (select l_suppkey, l_returnflag from lineitem where l_linenumber <= 5), b as (select l_suppkey, l_returnflag from lineitem where l_linenumber >= 2)
select *, 'left_only' as side from (select * from a except all select * from b) union all select *, 'right_only' from (select * from b except all select * from a)""")
def except_all_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return tables.bag_difference(t.where("l_linenumber <= 5").select("l_suppkey", "l_returnflag"), t.where("l_linenumber >= 2").select("l_suppkey", "l_returnflag"))


@_register("select cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows from (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.duplicates(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@_register(f"with {_COVERED} select dataset, symbol, date, round(completeness_ratio * 12, 6) as completeness_ratio from covered where completeness_ratio * 12 > 1")
def ratio_bounds_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _covered(spark, sf_dir).withColumn("completeness_ratio", F.col("completeness_ratio") * 12)
    return _round(checks.ratio_out_of_bounds(rows).select("dataset", "symbol", "date", "completeness_ratio"))


@_register(f"""with {_COVERED}, al as ({_ALIGNED}), part as (select * from covered where cast(symbol as int) % 4 <> 0 and dataset in ('klines', 'funding'))
select symbol, date from al where not exists (select 1 from part c where c.market = al.market and c.symbol = al.symbol and c.date = al.date and (c.timeframe = al.timeframe or al.timeframe = '1m' and c.dataset = 'funding' and c.timeframe = ''))""")
def alignment_backed_by_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = _covered(spark, sf_dir)
    part = covered.where("cast(symbol as int) % 4 <> 0 and dataset in ('klines', 'funding')")
    return checks.alignment_unbacked(coverage.alignment(covered, "1m"), part).select("symbol", "date")


@_register(f"""with {_BASE}, {_COVERED[len(_TICKS) + 2:]} select symbol, date from base l where not exists (select 1 from covered c where c.dataset = 'klines' and c.market = l.market and c.symbol = l.symbol and c.date = l.date and c.timeframe = l.timeframe)""")
def liquidity_backed_by_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.liquidity_unbacked(_base(spark, sf_dir), _covered(spark, sf_dir)).select("symbol", "date")


_TEXTS = ["cast(cast(round({0}, 6) as decimal(38, 6)) as varchar)", "cast(epoch_us({0}) as varchar)", "cast({0} as varchar)"]
_PRINTED = {"min_ts": 1, "max_ts": 1, "symbol": 2, "date": 2, "src_rows": 2}
_ROW_TEXT = " || ',' || ".join(
    f"coalesce(length({t}) || ':' || {t}, 'null')" for t in (_TEXTS[_PRINTED.get(c, 0)].format(c) for c in sorted(("symbol", "date", "open", "high", "low", "close", "volume", "dollar_volume", "vwap", "src_rows", "min_ts", "max_ts")))
)


@_register(f"""with {_TICKS}, b as (select {_BARS_1D}), h as (select cast('0x' || substr(md5({_ROW_TEXT}), 1, 15) as bigint) as x from b)
select count(*) as row_count, sum(x) as hash_sum, min(x) as hash_min, max(x) as hash_max from h""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.fingerprint(bars_1d(spark, sf_dir), digits=6)
