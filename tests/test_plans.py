"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from rows import AS_OF, article
from pyspark.sql import functions as F

from newsloom.operators import dedupe
from newsloom.operators.enrichment import enrich, with_timestamps
from newsloom.operators.filters import in_window, is_relevant
from newsloom.plans import catalog, oracle
from newsloom.plans.curate import curate


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_curation_stays_in_the_engine(raw):
    text = plan(curate(raw([article()]), AS_OF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_tags_are_computed_once(raw):
    df = enrich(with_timestamps(raw([article()]))).filter(is_relevant())
    assert plan(df).count("regexp_extract_all(lower") <= 1
    assert len(re.findall(r"Generate inline", plan(df))) == 2


def test_texts_cross_one_shuffle(spark, raw, tmp_path):
    rows = [article(title="CSRD", url=u, canonical_url=u) for u in ("https://a.example/1", "https://a.example/2")]
    raw(rows).write.parquet(str(tmp_path / "r"))
    df = curate(spark.read.parquet(str(tmp_path / "r")), AS_OF)
    assert [r.duplicate_count for r in df.collect()] == [2, 2]
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") >= 3
    # Whole rows move once, as winners of a URL; only keys move after that.
    moved = re.findall(r"(?m)^[^\w]*Exchange hashpartitioning\(dedupe_key", text)
    assert len(moved) <= 2


def test_an_empty_headline_spreads(spark, raw):
    rows = [article(article_id=f"r{i}", title="CSRD!", url=f"https://a.example/{i}",
                    canonical_url=f"https://a.example/{i}") for i in range(2000)]
    found = curate(raw(rows).repartition(4), AS_OF).select("duplicate_count", "article_id")
    assert [tuple(r) for r in found.groupBy("duplicate_count").count().collect()] == [(2000, 2000)]
    assert found.distinct().count() == 2000
    parts = {r[0] for r in spark.range(2000).select(
        F.pmod(F.xxhash64(F.concat(F.lit("https://a.example/"), "id")), F.lit(dedupe.SPREAD))).collect()}
    assert len(parts) == dedupe.SPREAD


def test_window_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT current_timestamp() AS published_ts, 'x' AS other").write.parquet(path)
    df = spark.read.parquet(path).filter(in_window(F.col("published_ts"), AS_OF, 7)).select("published_ts")
    text = plan(df)
    assert "PushedFilters: [Or(IsNull(published_ts)" in text
    assert "ReadSchema: struct<published_ts:timestamp>" in text


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.statements())


@pytest.mark.parametrize("name", ["canonical_urls", "regulation_tags", "market_tags", "relevance_scores",
                                  "curated_articles", "site_stats", "feed_items", "near_dup_pairs"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    pytest.importorskip("os").path.isdir(folder) or pytest.skip("no test data")
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    result = con.execute(oracle.statements()[name])
    names = sorted(d[0] for d in result.description)
    order = [[d[0] for d in result.description].index(n) for n in names]
    want = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    df = catalog.QUERIES[name](spark, folder)
    assert sorted(df.columns) == names
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want
