"""Every registered query of the library against its SQL counterpart."""

import os

import duckdb
import pytest

from tidemark.plans import catalog, lake_catalog

ORACLE_SQL, QUERIES = catalog.ORACLE_SQL | lake_catalog.ORACLE_SQL, catalog.QUERIES | lake_catalog.QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con




@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).fetch_df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    norm = lambda df: sorted(repr(tuple(None if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r)) for r in df[columns].astype(object).itertuples(index=False))
    a, b = norm(ours), norm(theirs)
    assert len(a) == len(b) and a == b, [(x, y) for x, y in zip(a, b, strict=False) if x != y][:3]
    assert a or name in ("missing_keys_anti", "near_threshold")  # few users at the smallest scale


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_fingerprint_ignores_order_and_sees_changes(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.tables import fingerprint

    df = QUERIES["bars_1d"](spark, SF)
    one = fingerprint(df).first()
    assert one == fingerprint(df.orderBy(F.rand(1))).first()
    assert one != fingerprint(df.withColumn("close", F.when(F.col("symbol") == df.first()["symbol"], 0.0).otherwise(F.col("close")))).first()


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_plans_prune_and_stay_in_the_jvm(spark):
    plan = QUERIES["bars_1d"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    scan = plan[plan.index("ReadSchema") :]
    assert "props" not in scan
