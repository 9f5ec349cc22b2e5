import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_date, expected_rows, normalize_symbol, resolve, timeframe_minutes
from tidemark.operators import archives, bars, coverage, liquidity, panel, selectors, tables, universe

D = date(2024, 1, 1)
ASOF = "asof_dv_30d_median double, asof_liquidity_rank_30d int, asof_dollar_volume double, asof_volume double, asof_close_price double"


def day(i):
    return D + timedelta(days=i)


def test_helpers():
    assert [timeframe_minutes(t) for t in ("1m", "4h", "1d")] == [1, 240, 1440]
    assert expected_rows("1m") == 1440 and expected_rows("7m") is None and expected_rows("x") is None
    assert normalize_symbol("XBTUSDM") == "BTCUSDM" and normalize_symbol("AXBT") == "AXBT"
    assert as_date("2024-01-01") == D and as_date(datetime(2024, 1, 1, 5)) == D and as_date(None) is None
    with pytest.raises(ValueError):
        as_date("yesterday")


def test_alias_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "Timestamp long, C double")
    assert resolve(df, "time") == "Timestamp" and resolve(df, "close") == "C"
    with pytest.raises(ValueError):
        resolve(df, "volume")


def test_first_and_last_skip_nulls_and_ties(spark):
    rows = [("A", 1, 1, None, 5.0), ("A", 1, 2, 2.0, 6.0), ("A", 2, 3, 3.0, 7.0), ("A", 2, 4, 4.0, None)]
    df = spark.createDataFrame(rows, "symbol string, ts long, id long, open double, close double").withColumn("high", F.lit(1.0)).withColumn("low", F.lit(1.0)).withColumn("volume", F.lit(0.0))
    r = bars.daily_bars(df, ["symbol"], ["id"]).first()
    assert (r.open, r.close, r.vwap, r.src_rows) == (2.0, 7.0, None, 4)


def fold(candidates, entry, exit_):
    members, out = set(), []
    by = {}
    for d, s, r in candidates:
        by.setdefault(d, {})[s] = r
    for d in sorted(by):
        now = set()
        for s, r in by[d].items():
            if (r is not None and r <= entry) or (s in members and not (r is not None and r > exit_)):
                now.add(s)
        members = now
        out += [(d, s) for s in now]
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_hysteresis_is_the_fold_over_days(spark, seed):
    rng = random.Random(seed)
    rows = [(day(d), s, rng.choice([None, *range(1, 10)])) for d in range(25) if rng.random() > 0.15 for s in "ABCDEFG" if rng.random() > 0.25]
    df = spark.createDataFrame([(d, d - timedelta(days=1), s, 1.0, r, 1.0, 1.0, 1.0) for d, s, r in rows], f"day date, asof_date date, symbol string, {ASOF}")
    got = sorted((r.day, r.symbol) for r in universe.hysteresis(df, 4, 7).collect())
    assert got == fold(rows, 4, 7)


def test_universe_shift_flags_and_turnover(spark):
    rows = [("futures", "1m", s, day(i), 1.0, 1.0, 1.0, 1.0, r) for i, ranks in enumerate([{"A": 50, "B": 120}, {"A": 150, "B": 90}, {"A": 110, "B": 131}]) for s, r in ranks.items()]
    q = spark.createDataFrame(rows, "market string, timeframe string, symbol string, date date, dollar_volume double, volume double, close_price double, dv_30d_median double, liquidity_rank_30d int")
    u = universe.universe_daily(q, day(1), day(3), all_candidates=True)
    got = {(r.day, r.symbol): (r.asof_date, r.in_universe, r.is_weekend) for r in u.collect()}
    assert got[day(1), "A"] == (day(0), True, False) and not got[day(1), "B"][1] and got[day(2), "B"][1] and not got[day(2), "A"][1] and not got[day(3), "B"][1]
    t = {r.day: r for r in universe.turnover(u).collect()}
    assert (t[day(1)].adds, t[day(1)].drops, t[day(1)].turnover_rate, t[day(1)].candidate_count) == (1, 0, 0.0, 2)
    assert (t[day(2)].adds, t[day(2)].drops, t[day(2)].turnover_rate) == (1, 1, 2.0)
    assert day(3) not in t
    with pytest.raises(ValueError):
        universe.hysteresis(u, 5, 4)


def test_returns_need_the_exact_day(spark):
    closes = {2: 11.0, 3: 12.0, 4: 13.0, 7: 17.0, 22: 32.0}
    rows = [("A", date(2024, 1, d), c) for d, c in closes.items()] + [("B", date(2024, 1, 2), 0.0), ("B", date(2024, 1, 3), 5.0)]
    df = spark.createDataFrame(rows, "symbol string, day date, close double")
    got = {(r.symbol, r.day.day): r for r in panel.exact_day_returns(df).collect()}
    a2 = got["A", 2]
    assert a2.ret_1d is None and abs(a2.fwd_ret_1d - 1 / 11) < 1e-12 and abs(a2.fwd_ret_5d - 6 / 11) < 1e-12 and abs(a2.fwd_ret_20d - 21 / 11) < 1e-12
    assert got["A", 7].ret_1d is None and got["A", 4].fwd_ret_1d is None
    assert got["B", 3].ret_1d is None and got["B", 3].log_ret_1d is None  # from zero
    with pytest.raises(ValueError):
        panel.exact_day_returns(df.union(df))


def test_panel_keeps_rows_without_bars(spark):
    u = spark.createDataFrame([(day(1), "A", day(0), True), (day(2), "A", day(1), True), (day(2), "B", day(1), False)], "day date, symbol string, asof_date date, in_universe boolean")
    for c in ("is_weekend", "asof_dv_30d_median", "asof_liquidity_rank_30d", "asof_dollar_volume", "asof_volume", "asof_close_price"):
        u = u.withColumn(c, F.lit(None).cast("double"))
    bar = spark.createDataFrame([("A", day(1), 2.0, 0.5), ("A", day(3), 4.0, None)], "symbol string, day date, close double, dollar_volume double")
    for c in ("open", "high", "low", "volume", "vwap", "src_rows", "max_ts"):
        bar = bar.withColumn(c, F.lit(1.0))
    got = {(r.day, r.symbol): r for r in panel.base_panel(u, bar).collect()}
    assert set(got) == {(day(1), "A"), (day(2), "A")}
    assert got[day(1), "A"].log_dollar_volume == 0.0 and got[day(2), "A"].close is None and got[day(2), "A"].log_dollar_volume is None
    s = {r.day: r for r in panel.panel_summary(panel.base_panel(u, bar)).collect()}
    assert s[day(2)].missing_close_pct == 1.0 and s[day(1)].n_symbols == 1


def test_ranges_equal_a_full_build_over_gaps(spark):
    rng = random.Random(5)
    rows = [("futures", "1m", s, day(i), float(rng.randint(1, 99))) for s in "ABC" for i in range(0, 200, rng.choice([1, 3, 5]))]
    df = spark.createDataFrame(rows, "market string, timeframe string, symbol string, date date, dollar_volume double")
    full = {(r.symbol, r.date): (r.dv_30d_median, r.liquidity_rank_30d) for r in liquidity.rolling_rank(df).collect()}
    part = {(r.symbol, r.date): (r.dv_30d_median, r.liquidity_rank_30d) for r in liquidity.rolling_rank_in_range(df, F.lit(day(120)), F.lit(day(150))).collect()}
    assert part and all(full[k] == v for k, v in part.items()) and len(part) == sum(day(120) <= d <= day(150) for _, d in full)


def test_selectors(spark):
    rows = [("futures", "1m", "A", day(i), 5) for i in range(3)] + [("futures", "1m", "B", day(0), 60), ("futures", "1m", "C", day(2), None), ("spot", "1m", "D", day(0), 1)]
    q = spark.createDataFrame(rows, "market string, timeframe string, symbol string, date date, liquidity_rank_30d int")
    names = lambda df: sorted(r.symbol for r in df.collect())
    assert names(selectors.candidate_superset(q, 60)) == ["A", "B"] and names(selectors.candidate_superset(q, 60, min_days=2)) == ["A"]
    assert names(selectors.candidate_superset(q, 60, start=day(1))) == ["A"]
    assert names(selectors.near_threshold(q, 10, 5)) == ["A"] and names(selectors.near_threshold(q, 58, 5, lookback=1)) == []
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            selectors.candidate_superset(q, bad)


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, v string, w int")
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, v string, w int")
    got = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert got(tables.upsert(old, new, ["k"])) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    assert got(tables.upsert(old, new, ["k"], keep=["w"])) == [(1, "a", 1), (2, None, None), (3, "c", 3)]
    assert got(tables.upsert(old, new.drop("w"), ["k"], keep=["w"])) == [(1, "a", 1), (2, None, None), (3, "c", None)]
    assert got(tables.replace_where(old, new, F.col("w") == 1)) == [(2, "b", None), (2, None, 9), (3, "c", 3)]
    assert tables.duplicates(old.union(old).union(new), ["k"]).first()[0] == 3
    e = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 1.0, "z")], "k int, a double, b string")
    a = spark.createDataFrame([(1, 1.0 + 1e-13, "x"), (2, 0.0, None), (4, 1.0, "z")], "k int, a double, b string")
    assert {r.k: (r.side, r.mismatch) for r in tables.compare(e, a, ["k"], ["a", "b"]).collect()} == {1: ("both", ""), 2: ("both", "a,b"), 3: ("left_only", ""), 4: ("right_only", "")}


def test_raw_times_round_half_to_even(spark):
    raw = spark.createDataFrame([("1.5",), ("2.5",), ("1.7e12",), ("x",)], "time string").selectExpr("if(time = 'x', null, time) as time", "'1' as open", "'1' as high", "'1' as low", "'1' as close")
    assert [r.time_ms for r in archives.normalize_bars(raw, volume=False).collect()] == [2, 2, 1_700_000_000_000, None]


def test_partial_coverage_equals_whole(spark):
    rows = [("A", day(0), datetime(2024, 1, 1, 0, i), i % 3) for i in range(50)]
    df = spark.createDataFrame(rows, "symbol string, date date, ts timestamp, file int")
    whole = coverage.coverage(df, ["symbol", "date"], "1m").drop("num_files")
    merged = coverage.merge_partial(coverage.coverage(df, ["symbol", "date", "file"], "1m"), ["symbol", "date"]).drop("num_files")
    assert whole.first().asDict() == merged.first().asDict()


def test_minute_bars_stream(spark, tmp_path):
    from tidemark.streaming.minutes import minute_bars

    rows = [("A", datetime(2024, 1, 1, 0, 0, s), float(s), 1.0) for s in (5, 1, 40)] + [("A", datetime(2024, 1, 1, 2), 9.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, price double, volume double")
    df.write.parquet(str(tmp_path / "in"))
    q = minute_bars(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("append").format("memory").queryName("minute_bars").start()
    q.processAllAvailable()
    q.stop()
    r = spark.table("minute_bars").collect()
    assert [(x.open, x.high, x.low, x.close, x.volume) for x in r] == [(1.0, 40.0, 1.0, 40.0, 3.0)]
    assert minute_bars(df).count() == 2


def test_first_rows_and_update_from(spark):
    from tidemark.operators import tables

    rows = [("a", 2, "x", None), ("a", 1, "z", 5), ("a", 1, "y", 7), ("b", 3, "x", 1)]
    df = spark.createDataFrame(rows, "k string, o int, v string, n int")
    for again in (df, df.repartition(3), df.orderBy(F.desc("v"))):
        assert sorted(tuple(r) for r in tables.first_rows(again, ["k"], ["o"]).collect()) == [("a", 1, "y", 7), ("b", 3, "x", 1)]
    assert tables.first_rows(df.select("k"), ["k"]).count() == 2
    source = spark.createDataFrame([("b", 9, None)], "k string, n int, extra string")
    got = sorted(tuple(r) for r in tables.update_from(df, source, ["k"], ["n", "extra"]).select("k", "o", "v", "n", "extra").collect() if r.k == "b" or r.o == 2)
    assert got == [("a", 2, "x", None, None), ("b", 3, "x", 9, None)]


def test_panel_fails_on_repeated_days(spark):
    u = spark.createDataFrame([(day(1), "A", day(0), True)], "day date, symbol string, asof_date date, in_universe boolean")
    for c in ("is_weekend", "asof_dv_30d_median", "asof_liquidity_rank_30d", "asof_dollar_volume", "asof_volume", "asof_close_price"):
        u = u.withColumn(c, F.lit(None).cast("double"))
    bar = spark.createDataFrame([("A", day(1), 2.0), ("A", day(1), 3.0)], "symbol string, day date, close double")
    for c in ("open", "high", "low", "volume", "vwap", "src_rows", "max_ts", "dollar_volume"):
        bar = bar.withColumn(c, F.lit(1.0))
    with pytest.raises(Exception, match="not unique"):
        panel.base_panel(u, bar).collect()
    assert panel.base_panel(u, bar, check=False).count() == 2
