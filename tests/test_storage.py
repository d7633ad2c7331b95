"""Landing zone, stored tables and the incremental path."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from rows import AS_OF, article
from pyspark.sql import functions as F

from newsloom.operators.quality import differing_rows
from newsloom.plans.curate import curate
from newsloom.sources import curated as store
from newsloom.sources import landing
from newsloom.streaming.incremental import curate_prepared, prepare_new_files


def rows(n=6, first=0):
    return [article(article_id=f"a{i}", url=f"https://a.example/{i % 4}", canonical_url=f"https://a.example/{i % 4}",
                    title=f"Net zero plan é {i} \"quoted\" under CSRD", categories=["x,y", "z"] if i % 2 else [],
                    source_type="regulator" if i % 3 else "media",
                    published_at=(AS_OF - timedelta(days=i + 1)).isoformat() if i % 5 else None)
            for i in range(first, first + n)]


def land(raw, path, data, run):
    landing.land(raw(data).withColumn("ingest_date", F.lit(date(2026, 8, 14))).withColumn("run_id", F.lit(run)), path)


def test_landing_round_trip_with_bad_lines(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    land(raw, path, rows(), "1")
    folder = tmp_path / "raw" / "ingest_date=2026-08-14" / "run_id=2"
    folder.mkdir()
    (folder / "bad.jsonl").write_text('{"title": "cut off\n')
    (folder / "stray.json").write_text('{"title": "not ours", "url": "u"}\n')
    (folder / "_stats.json").write_text('{"title": "not ours", "url": "u"}\n')
    scan = landing.read_landing(spark, path)
    assert differing_rows(landing.raw_rows(scan), raw(rows())).count() == 0
    counts = {r.run_id: (r.lines, r.corrupt) for r in landing.quarantine_counts(scan).collect()}
    assert counts == {"1": (6, 0), "2": (1, 1)}
    assert landing.read_landing(spark, path, since=date(2026, 8, 15)).select("url").count() == 0
    assert landing.read_landing(spark, path, since=date(2026, 8, 14)).select("url").count() == 7
    assert scan.filter("run_id = '1'").select("ingest_date").first()[0] == date(2026, 8, 14)


def test_landing_keeps_the_window(raw):
    kept = landing.keep_window(raw(rows(9)), AS_OF, 7)
    assert {r.article_id for r in kept.collect()} == {"a0", "a1", "a2", "a3", "a4", "a5", "a6"}


def test_curated_store_keeps_days_and_drops_stale_markets(spark, raw, tmp_path):
    path = str(tmp_path / "curated")
    df = curate(raw(rows()), AS_OF)
    store.write_curated(df, path, date(2026, 8, 14))
    other_day = curate(raw(rows()), AS_OF - timedelta(days=1))
    store.write_curated(other_day, path, date(2026, 8, 13))
    back = store.read_curated(spark, path)
    assert back.columns == df.columns and back.dtypes == df.dtypes
    assert differing_rows(back.filter("ingest_date = '2026-08-14'"), df).count() == 0
    us = curate(raw([article(source_market="US", title="Solar plan in Texas under an old climate act", summary="x")]), AS_OF)
    store.write_curated(us, path, date(2026, 8, 14))
    days = {(str(r.ingest_date), r.primary_market) for r in store.read_curated(spark, path).collect()}
    assert ("2026-08-14", "US") in days and ("2026-08-14", "EU") not in days and ("2026-08-13", "EU") in days


def test_failing_write_keeps_the_old_day(spark, raw, tmp_path):
    path = str(tmp_path / "curated")
    df = curate(raw(rows()), AS_OF)
    store.write_curated(df, path, date(2026, 8, 14))
    broken = df.withColumn("title", F.when(F.col("title") == "", F.col("title"))
                           .otherwise(F.raise_error(F.lit("lost source")).cast("string")))
    with pytest.raises(Exception, match="lost source"):
        store.write_curated(broken, path, date(2026, 8, 14))
    assert differing_rows(store.read_curated(spark, path), df).count() == 0
    assert [f.name for f in (tmp_path / "curated").iterdir() if not f.name.startswith(".")] == ["ingest_date=2026-08-14"]


def test_exports(spark, raw, tmp_path):
    df = curate(raw(rows()), AS_OF)
    store.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(str(tmp_path / "csv"))
    assert {r.categories for r in back.collect()} == {None, "x,y|z"}
    assert {r.title for r in back.collect()} == {r.title for r in df.collect()}
    store.write_jsonl(df, str(tmp_path / "json"))
    assert set(spark.read.json(str(tmp_path / "json")).columns) == set(df.columns)
    names = store.write_rollups(df, str(tmp_path / "out"))
    assert set(names) == {"by_market_day", "by_regulation", "by_topic", "by_pillar", "by_source"}
    assert spark.read.parquet(names["by_source"]).count() == 1


def test_incremental_equals_one_shot(spark, raw, tmp_path):
    base = str(tmp_path)

    def tag():
        prepare_new_files(spark, f"{base}/raw", f"{base}/prepared", f"{base}/check").awaitTermination()
    land(raw, f"{base}/raw", rows(6), "1")
    tag()
    land(raw, f"{base}/raw", rows(6, first=4), "2")
    tag()
    tag()
    everything = raw(rows(6) + rows(6, first=4))
    for as_of in (AS_OF, AS_OF + timedelta(days=3)):
        got = curate_prepared(spark, f"{base}/prepared", as_of)
        assert got.count() > 0
        assert differing_rows(got, curate(everything, as_of)).count() == 0


def test_statistics_are_appended(spark, tmp_path):
    per_feed = spark.createDataFrame([("r1", "a", 1)], "run_id string, source_id string, articles bigint")
    per_run = spark.createDataFrame([("r1", 1)], "run_id string, feeds_requested bigint")
    for _ in range(2):
        store.append_stats(per_feed, per_run, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/run_stats").count() == 2
    assert spark.read.parquet(f"{tmp_path}/feed_stats").count() == 2


def test_work_folder_needs_no_setting(spark):
    from newsloom import session
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.work_root(spark)
    assert folder == session.work_root(spark)
    assert spark.conf.get("spark.checkpoint.dir", None) == named  # nothing was set
    if named:
        assert folder == named.rstrip("/")


def test_scans_are_left_alone_unless_told(spark):
    from newsloom.session import spread
    rows = spark.range(10).coalesce(1)
    assert spread(rows) is rows
    spark.conf.set("newsloom.scan.partitions", "3")
    try:
        assert spread(rows).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("newsloom.scan.partitions")


def test_scores_keep_all_their_digits(spark):
    from newsloom.operators import ranking, rollups
    rows = spark.createDataFrame(
        [("a", "x y z", 0.62500, "2026-08-13"), ("b", "u v w", 0.62501, "2026-08-13"),
         ("c", "p q r", 1 / 3, "2026-08-12"), ("d", "k l m", None, "2026-08-11")],
        "article_id string, title string, relevance_score double, d string").selectExpr(
        "*", "to_date(d) AS published_date", "'' AS summary", "'EU' AS primary_market", "'s' AS source_id",
        "array('EU') AS markets")
    assert [r.article_id for r in ranking.select_top(rows, 3).collect()] == ["b", "a", "c"]
    assert [r.rank for r in ranking.number_stories(rows).orderBy("article_id").collect()] == [2, 1, 3, 4]
    got = {str(r.published_date): r.avg_relevance for r in rollups.by_market_day(rows).collect()}
    assert got == {"2026-08-13": 0.625, "2026-08-12": 0.333, "2026-08-11": None}


def test_scores_of_any_size(spark):
    from newsloom.operators import ranking, rollups
    nan = float("nan")
    rows = spark.createDataFrame(
        [("a", 2500.0, 1), ("b", 2500.0004, 1), ("c", 1e6, 1), ("d", -3.5, 2), ("e", nan, 2), ("f", None, 2),
         ("g", 5e18, 3), ("h", 1e18, 3), ("i", 4999.99950001, 4), ("j", -0.0005, 5), ("k", nan, 6)],
        "article_id string, relevance_score double, d int").selectExpr(
        "*", "date_add(date'2026-08-10', d) AS published_date", "array('EU') AS markets", "'EU' AS primary_market",
        "'s' AS source_id", "concat('title', article_id, ' only', article_id) AS title", "'' AS summary")
    assert [r.article_id for r in ranking.select_top(rows, 6).collect()] == ["g", "h", "c", "i", "b", "a"]
    ranked = [r.article_id for r in ranking.number_stories(rows).orderBy("rank").collect()]
    assert ranked[-5:] == ["e", "f", "k", "j", "d"]  # no score ranks like 0
    got = {r.published_date.day: r.avg_relevance for r in rollups.by_market_day(rows).collect()}
    assert got == {11: 335000.0, 12: -3.5, 13: 3e18, 14: 5000.0, 15: 0.0, 16: None}


def test_quarantine_names_file_and_line(spark, raw, tmp_path):
    path = str(tmp_path / "zone")
    landing.land(raw([article()]).withColumn("ingest_date", F.lit(date(2026, 8, 14))).withColumn(
        "run_id", F.lit("r1")), path)
    folder = tmp_path / "zone" / "ingest_date=2026-08-14" / "run_id=r1"
    (folder / "more.jsonl").write_text('{"article_id": "x", "title": \n[1]\n')
    (folder / "stray.json").write_text("not read")
    rows = landing.quarantine(landing.read_landing(spark, path)).orderBy("line").collect()
    assert [r.line for r in rows] == ["[1]", '{"article_id": "x", "title": ']
    assert all(r.file.endswith("/run_id=r1/more.jsonl") and r.block_start == 0 and r.run_id == "r1" for r in rows)


def test_missing_articles_of_reports(spark):
    from newsloom.operators import quality
    reports = spark.createDataFrame([("a", "see https://x.example/1 and more"), ("n", None)],
                                    "report_id string, markdown string")
    stories = spark.createDataFrame(
        [("a", "https://x.example/1", None, 1), ("a", "https://x.example/2", "", 2), ("a", None, None, 3),
         ("b", "https://x.example/1", None, 4), ("n", "https://x.example/1", None, 5), ("a", "https://x.example/2", None, 6)],
        "report_id string, url string, canonical_url string, n int")
    dated = stories.withColumn("published_date", F.lit(date(2026, 8, 14)))
    assert sorted(r.n for r in quality.missing_articles(reports, dated).collect()) == [2, 4, 5, 6]
    text = quality.missing_articles(reports, dated)._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
