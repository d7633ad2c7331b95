"""Stateless per-article work: required fields, tags, score, event time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tagging
from ..functions.dates import parse_datetime
from ..functions.text import title_key
from ..functions.vocabulary import lexicon_hits
from ..lexicon import DEFAULT_LEXICON, Lexicon


@dataclass(frozen=True)
class Features:
    """Columns a scorer may use."""

    core_hits: Column
    core_in_title: Column
    esg_pillars: Column
    regulations: Column
    topics: Column
    source_type: Column
    title: Column
    summary: Column


Scorer = Callable[[Features], Column]


def points_scorer(f: Features) -> Column:
    """The default relevance score, 0.0 to 1.0 in hundredths."""
    points = tagging.relevance_points(
        f.core_hits, f.core_in_title, f.esg_pillars, f.regulations, f.topics,
        f.source_type, f.summary)
    return points.cast("double") / F.lit(100.0)


def materialize(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later operators read as values.

    Filters written after this call are not pushed below it, so an expensive
    expression runs once per row instead of once in the filter and again in
    the projection.  (A generator with a single element; no shuffle.)
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(packed))


def require_fields(df: DataFrame) -> DataFrame:
    """Rows with a headline and a URL."""
    return df.filter((F.col("title") != "") & (F.col("url") != ""))


def with_timestamps(df: DataFrame) -> DataFrame:
    """Parse the ISO text of publication and fetch time; bad text is NULL."""
    return df.withColumns({"published_ts": parse_datetime(F.col("published_at")),
                           "fetched_ts": parse_datetime(F.col("fetched_at"))})


def enrich(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON,
           scorer: Scorer = points_scorer) -> DataFrame:
    """Add tags, markets, score and de-duplication keys to raw articles."""
    raw_text = tagging.search_text(F.col("title"), F.col("summary"), F.col("categories"))
    text, hits = F.col("_text"), F.col("_hits")
    scanned = materialize(df.withColumn("_raw", raw_text).withColumn("_text", F.lower("_raw")),
                          {"_hits": lexicon_hits(text, lexicon)})
    tagged = materialize(scanned, {
        "esg_pillars": tagging.pillar_tags(hits, lexicon),
        "regulations": tagging.regulation_tags(text, hits, lexicon),
        "topics": tagging.topic_tags(hits, lexicon),
        "markets": tagging.market_tags(text, F.col("_raw"), hits, F.col("source_market"), lexicon),
        "_core_hits": tagging.core_hits(text, hits, lexicon),
        "_core_in_title": tagging.core_in_title(F.col("title"), lexicon),
        "title_key": title_key(F.col("title")),
    }).drop("_raw", "_text", "_hits")
    features = Features(*[F.col(c) for c in (
        "_core_hits", "_core_in_title", "esg_pillars", "regulations", "topics",
        "source_type", "title", "summary")])
    score = {"relevance_score": scorer(features)}
    # A model is called once a row, not again for each filter on its score.
    scored = (materialize(tagged, score) if getattr(scorer, "runs_python", False)
              else tagged.withColumns(score))
    return scored.withColumns({
        "is_eu": F.array_contains("markets", "EU"),
        "is_us": F.array_contains("markets", "US"),
        "has_publish_date": F.coalesce(F.col("published_at"), F.lit("")) != "",
        "dedupe_key": F.coalesce(F.nullif(F.col("canonical_url"), F.lit("")),
                                 F.col("title_key")),
    }).drop("_core_hits", "_core_in_title")


def primary_market() -> Column:
    """One market label per article."""
    eu, us = F.col("is_eu"), F.col("is_us")
    return (F.when(eu & us, F.lit("EU_US")).when(eu, F.lit("EU"))
            .when(us, F.lit("US")).otherwise(F.lit("GLOBAL")))
