"""Queries on events denser than the driver's, against their SQL."""

from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest

from tidemark.operators.bars import daily_bars
from tidemark.plans import catalog, lake_catalog


def both(spark, folder, events, name):
    """Rows of a query and of its SQL over (event_id, ts, user_id, event_type, value)."""
    df = pd.DataFrame(events, columns=["event_id", "ts", "user_id", "event_type", "value"])
    df["ts"] = df["ts"].astype("datetime64[us]")
    path, con = f"{folder}/events.parquet", duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"copy (select *, '' as props from df) to '{path}' (format parquet)")
    con.execute(f"create view events as select * from '{path}'")
    plans = catalog if name in catalog.QUERIES else lake_catalog
    ours, theirs = plans.QUERIES[name](spark, str(folder)).toPandas(), con.execute(plans.ORACLE_SQL[name]).fetch_df()
    return [sorted(tuple(str(v) for v in r) for r in x[sorted(x.columns)].astype(object).itertuples(index=False)) for x in (ours, theirs)]


@pytest.mark.parametrize("name", ["bars_1d", "fingerprint"])
def test_halves_of_the_last_place_round_as_in_sql(spark, tmp_path, name):
    # 3119.01 / 32 is 97.4690625, and its sum in doubles a little less
    day = datetime(2024, 1, 3)
    ticks = [(307535, 112.15), (307900, 72.68), (308285, 31.75), (308342, 10.84), (309289, 147.3), (309615, 260.2)]
    ours, theirs = both(spark, tmp_path, [(i, day + timedelta(hours=n), 1, "click", v) for n, (i, v) in enumerate(ticks)], name)
    if name == "fingerprint":
        ours, theirs = ([tuple(str(int(float(v))) if "." in v else v for v in r) for r in x] for x in (ours, theirs))
    assert ours == theirs


def test_sums_in_order_do_not_depend_on_partitions(spark):
    # one by one the ones are lost in the first volume, together they are not
    rows = spark.createDataFrame([("a", i, 1.0, 1.0, 1.0, 1.0, 1e16 if not i else 1.0) for i in range(9)], "symbol string, ts int, open double, high double, low double, close double, volume double")
    for n in (1, 3, 9):
        r = daily_bars(rows.repartitionByRange(n, "ts"), ["symbol"], in_order=True).first()
        assert (r.volume, r.dollar_volume, r.vwap, r.src_rows) == (1e16, 1e16, 1.0, 9)


def test_violations_are_those_spoilt_where_days_have_more_ticks_than_minutes(spark, tmp_path):
    events = [(day + timedelta(seconds=n), user, kind) for day in (datetime(2024, 1, 1), datetime(2024, 1, 20)) for user in range(3) for kind in ("click", "view", "purchase", "signup") for n in range(1500 if (user, kind) == (1, "purchase") else 2)]
    ours, theirs = both(spark, tmp_path, [(i, ts, user, kind, 5.0 + i % 7) for i, (ts, user, kind) in enumerate(events)], "lake_violations")
    assert ours == theirs


@pytest.mark.parametrize("name", ["bars_1d", "fingerprint"])
def test_sums_add_rows_as_they_are_stored(spark, tmp_path, name):
    # the vwap is a half in the seventh place: added as stored it is rounded down, by time or by id up
    day = datetime(2024, 1, 3)
    ticks = [(811, 290.34), (208, 103.17), (305, 227.93), (306, 279.19), (565, 122.77), (169, 230.79)]
    events = [(i, day + timedelta(hours=9 - n), 1, "click", v) for n, (i, v) in enumerate(ticks)]
    ours, theirs = both(spark, tmp_path, events, name)
    if name == "fingerprint":
        ours, theirs = ([tuple(str(int(float(v))) if "." in v else v for v in r) for r in x] for x in (ours, theirs))
    assert ours == theirs
