"""Routing of stories to report sections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tagging
from ..functions.vocabulary import lexicon_hits
from ..lexicon import DEFAULT_LEXICON, Lexicon
from .enrichment import materialize


def with_section(df: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Add pillar and finance strengths and the section they lead to."""
    text = F.lower(tagging.search_text(F.col("title"), F.col("summary"), F.col("categories")))
    scanned = materialize(df, {"_hits": lexicon_hits(text, lexicon)})
    strengths = tagging.pillar_strength(F.col("_hits"), F.col("topics"), lexicon)
    names = {p: f"strength_{p.lower()}" for p in strengths}
    rows = scanned.withColumns({
        **{names[p]: c for p, c in strengths.items()},
        "strength_finance": tagging.finance_strength(F.col("_hits"), lexicon)})
    return rows.withColumn("section", tagging.section_of(
        {p: F.col(n) for p, n in names.items()}, F.col("strength_finance"),
        F.col("topics"))).drop("_hits")


def group_by_section(stories: DataFrame) -> DataFrame:
    """Ranked stories of each section as a list in rank order.

    For a briefing's own stories, whose number is bounded by its top-n.
    """
    return stories.groupBy("section").agg(
        F.array_sort(F.collect_list(F.struct("rank", "article_id", "title"))).alias("stories"))
