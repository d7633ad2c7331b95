"""Aggregates over curated articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Below this size scores are averaged exactly.
EXACT_BELOW = 1e9


def average_score() -> Column:
    """Mean relevance to three places, half up.

    Whole parts are added up as integers and the rest as decimals of 15 places,
    so the result does not depend on how partitions are added up, and no digit
    of a caller's scorer is lost.  Groups with a score of ``EXACT_BELOW`` or more
    are averaged as doubles; what is no finite number is left out.
    """
    score = F.col("relevance_score").cast("double")
    usable = F.when(F.abs(score) < float("inf"), score)
    small = F.when(F.abs(score) < EXACT_BELOW, score)
    n = F.count(small)
    whole = F.sum(F.floor(small))
    over = F.pmod(whole, n)
    rest = F.sum((small - F.floor(small)).cast("decimal(18,15)"))
    exact = (F.round((whole - over) / n).cast("long") * 1000
             + F.floor((rest * 2000 + over * 2000 + n) / (n * 2))).cast("double") / F.lit(1000.0)
    return F.when(F.max(F.abs(usable)) < EXACT_BELOW, exact).otherwise(F.round(F.avg(usable), 3))


def by_market_day(df: DataFrame) -> DataFrame:
    """Articles, mean relevance and sources per market and day."""
    return df.groupBy("primary_market", "published_date").agg(
        F.count(F.lit(1)).alias("article_count"),
        average_score().alias("avg_relevance"),
        F.countDistinct("source_id").alias("source_count"),
    ).orderBy("published_date", "primary_market")


def by_regulation(df: DataFrame) -> DataFrame:
    """Articles per regulation and market."""
    return (df.select(F.explode("regulations").alias("regulation"), "primary_market")
            .groupBy("regulation", "primary_market")
            .agg(F.count(F.lit(1)).alias("article_count"))
            .orderBy(F.desc("article_count"), "regulation", "primary_market"))


def by_topic(df: DataFrame) -> DataFrame:
    """Articles and mean relevance per topic."""
    return (df.select(F.explode("topics").alias("topic"), "relevance_score")
            .groupBy("topic")
            .agg(F.count(F.lit(1)).alias("article_count"),
                 average_score().alias("avg_relevance"))
            .orderBy(F.desc("article_count"), "topic"))


def by_pillar(df: DataFrame) -> DataFrame:
    """Articles per pillar and market."""
    return (df.select(F.explode("esg_pillars").alias("pillar"), "primary_market")
            .groupBy("pillar", "primary_market")
            .agg(F.count(F.lit(1)).alias("article_count"))
            .orderBy("pillar", "primary_market"))


def by_source(df: DataFrame) -> DataFrame:
    """Articles per source."""
    return (df.groupBy("source_name").agg(F.count(F.lit(1)).alias("article_count"))
            .orderBy(F.desc("article_count"), "source_name"))


ROLLUPS = {"by_market_day": by_market_day, "by_regulation": by_regulation,
           "by_topic": by_topic, "by_pillar": by_pillar, "by_source": by_source}


def build_rollups(df: DataFrame) -> dict[str, DataFrame]:
    """All rollups by name."""
    return {name: build(df) for name, build in ROLLUPS.items()}


def site_counts(df: DataFrame) -> DataFrame:
    """Counts by market, source, pillar and regulation as one long table.

    Every row is turned into its (dimension, key) pairs, so the table is read
    and shuffled once, not once per dimension.
    """
    def pairs(dimension: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(
            F.lit(dimension).alias("dimension"), k.alias("key")))

    def some(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast("array<string>"))

    return (df.select(F.inline(F.concat(
                pairs("market", F.array("primary_market")),
                pairs("source", F.array("source_name")),
                pairs("pillar", some("esg_pillars")),
                pairs("regulation", some("regulations")))))
            .groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n")))


def site_summary(df: DataFrame) -> DataFrame:
    """Total, covered dates (``n/a`` if none) and number of sources."""
    day = F.date_format("published_date", "yyyy-MM-dd")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.min(day), F.lit("n/a")).alias("first_date"),
        F.coalesce(F.max(day), F.lit("n/a")).alias("last_date"),
        F.countDistinct("source_name").alias("source_count"))
