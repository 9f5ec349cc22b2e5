"""The pipeline's stages on a small fixture, and registered queries against their SQL."""

import hashlib
import os
import random

import duckdb
import pytest

import corpus_pipeline
from test_llm_operators import brute_components, brute_repeats, junk, sentence
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, root, seed=5):
    rng = random.Random(seed)
    good = lambda n: ". ".join(sentence(rng, 10, 3000).capitalize() for _ in range(n)) + "."
    item, passage = sentence(rng, 30, 3000), sentence(rng, 60, 3000)
    texts = [good(rng.randint(6, 20)) for _ in range(150)] + [junk(rng, i % 5) for i in range(60)]
    labels = [(i, int(i < 150)) for i in range(210)]
    base = good(30)
    near = base.split()
    near[100] = "edited"
    texts += [base, base, " ".join(near), good(8) + " " + passage + " " + good(8), good(7) + " " + passage, good(9) + " " + item + " " + good(4), passage]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), len(t)) for i, t in enumerate(texts)]
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0), (None, good(9), "en", "b", 5), rows[3]]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    root = str(tmp_path)
    rows = fixture(spark, root)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, root)
        df.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        seen[name] = [tuple(r) for r in docs.collect()]
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] + ["copy"] * (name == "mix")
    ids = lambda name: sorted((r[0] for r in seen[name]), key=str)
    # quality: rows unchanged, junk gone, good kept
    assert set(seen["quality"]) <= set(rows)
    assert not [i for i in ids("quality") if i is not None and 150 <= i < 210] and len([i for i in ids("quality") if i is not None and i < 150]) >= 150
    # near copies: the smallest of each group, rows without an id all stay
    comps = brute_components([(r[0], r[1]) for r in seen["quality"]])
    assert ids("near_copies") == sorted([*{i for i, c in comps.items() if i == c}, None], key=str)
    assert 210 in ids("near_copies") and not {211, 212} & set(ids("near_copies"))
    # substrings
    expected = {(i, h) for i, n, gone, h in brute_repeats([(r[0], r[1]) for r in seen["near_copies"]], 50) if gone < n or n == 0}
    assert {(r[0], hashlib.sha256(b" ".join((r[1] or "").encode().split())).hexdigest()) for r in seen["substrings"]} == expected
    assert 216 not in ids("substrings") and all(r[4] == len(r[1]) for r in seen["substrings"] if r[0] in (213, 214))
    # decontamination: the one document with the item goes, clean ones stay
    assert set(ids("substrings")) - set(ids("benchmark")) == {215}
    # mixing: copies of documents, sources near their targets
    assert set(ids("mix")) <= set(ids("benchmark")) and {r[:5] for r in seen["mix"]} <= set(seen["benchmark"])
    size = lambda rs: sum(len((r[1] or "").split()) for r in rs)
    assert abs(size(seen["mix"]) - size(seen["benchmark"])) < 0.05 * size(seen["benchmark"])
    assert sorted(map(str, corpus_pipeline.run(spark, root).collect())) == sorted(map(str, docs.collect()))


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    theirs, ours = con.execute(ORACLE_SQL[name]).fetch_df(), QUERIES[name](spark, SF).toPandas()
    columns = sorted(theirs.columns)
    assert columns == sorted(ours.columns)
    assert sorted(map(str, ours[columns].values.tolist())) == sorted(map(str, theirs[columns].values.tolist()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_gives_a_row_for_each(spark, name):
    n = {"documents": spark.read.parquet(f"{SF}/documents.parquet").count(), "pages": spark.read.parquet(f"{SF}/pages.parquet").count()}
    rows = QUERIES[name](spark, SF).count()
    assert rows == n["pages" if name in ("op9_url_filter", "op10_html_extract") else "documents"] or name == "op1_decontaminate"


def test_held_out_quality(spark):
    """Held-out accuracy of the registered classifier."""
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op3_quality_qda"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert rows.selectExpr("avg(cast(predicted = quality as double))").first()[0] > 0.95
