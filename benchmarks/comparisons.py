"""Each design choice against the obvious alternative, same data, same result."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from newsloom.lexicon import CORE_PATTERNS, PILLARS, TOPICS
from newsloom.operators import dedupe, neardup, ranking
from newsloom.operators.enrichment import enrich, with_timestamps
from newsloom.plans import catalog
from newsloom.plans.article_view import AS_OF, raw_articles
from newsloom.plans.curate import with_event_time
from newsloom.session import cut_lineage, spread


def _seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def _udf_tags(raw: DataFrame) -> DataFrame:
    """Themes, topics and core hits only, as a row-at-a-time Python UDF."""
    core = re.compile("|".join(CORE_PATTERNS))

    @F.udf(T.StructType([T.StructField("pillars", T.ArrayType(T.StringType())),
                         T.StructField("topics", T.ArrayType(T.StringType())),
                         T.StructField("core", T.IntegerType())]))
    def tag(title, summary, categories):
        text = " ".join([title or "", summary or "", *(categories or [])]).lower()
        return ([p for p, ks in PILLARS.items() if any(k in text for k in ks)],
                [t for t, ks in TOPICS.items() if any(k in text for k in ks)],
                len(set(core.findall(text))))

    return raw.select("source_id", tag("title", "summary", "categories").alias("t"))


def enrichment(spark: SparkSession, raw: DataFrame) -> dict:
    return {"native_all_tags_sec": _seconds(enrich(with_timestamps(raw))),
            "python_udf_three_tags_sec": _seconds(_udf_tags(raw))}


def title_dedupe(spark: SparkSession, rows: DataFrame) -> dict:
    window = Window.partitionBy("title_key", "published_date")
    by_window = (rows.withColumn("rn", F.row_number().over(window.orderBy(*dedupe.precedence())))
                 .withColumn("n", F.count(F.lit(1)).over(window))
                 .filter((F.col("rn") == 1) | (F.length("title_key") < dedupe.MIN_TITLE_KEY)))
    return {"one_aggregate_sec": _seconds(dedupe.by_title_and_day(rows)),
            "window_with_or_filter_sec": _seconds(by_window)}


def near_duplicates(spark: SparkSession, sf_dir: str) -> dict:
    rows = catalog.stored_curated(spark, sf_dir).withColumn("_rank", ranking.rank_value())
    sigs = neardup.signatures(rows, "_rank")
    prepared = spread(cut_lineage(neardup._prepare(
        neardup._fold_copies(sigs), neardup.THRESHOLD, neardup.Tuning()), "bench-tokens"))
    one = prepared.select("id", "tokens", F.explode("tokens").alias("key"))
    plain = (one.alias("s").join(one.alias("l"), (F.col("s.key") == F.col("l.key")) & (F.col("s.id") < F.col("l.id"))))
    s, l = (neardup._keys(prepared, p) for p in (True, False))
    keyed = s.alias("s").join(l.alias("l"), (F.col("s.key") == F.col("l.key")) & (
        (F.col("s.m") < F.col("l.m")) | ((F.col("s.m") == F.col("l.m")) & (F.col("s.id") < F.col("l.id")))))
    start = time.perf_counter()
    exact = plain.filter(neardup.is_near(F.col("s.tokens"), F.col("l.tokens"))).select("s.id", "l.id").distinct().count()
    plain_sec = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    found = neardup._pairs_within(prepared, neardup.THRESHOLD).count()
    return {"stories": prepared.count(), "plain_candidates": plain.count(), "keyed_candidates": keyed.count(),
            "plain_pairs": exact, "keyed_pairs": found, "plain_sec": plain_sec,
            "keyed_sec": round(time.perf_counter() - start, 3)}


def run(spark: SparkSession, sf_dir: str) -> dict:
    raw = spread(cut_lineage(raw_articles(spark, sf_dir), "bench-raw"))
    tagged = with_event_time(enrich(with_timestamps(raw)), AS_OF)
    unique = cut_lineage(dedupe.by_url(tagged.filter(F.col("url") != "")), "bench-unique")
    return {"enrichment": enrichment(spark, raw), "title_dedupe": title_dedupe(spark, unique),
            "near_duplicates": near_duplicates(spark, sf_dir)}
