"""Orders, top-k selections and display projections of curated articles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .filters import any_market, one_market
from .neardup import first_distinct

TOP_STORIES = 20
TOP_DIGEST = 25
BATCH_SIZE = 5


def best_url() -> Column:
    """Canonical address, or the original one where that is missing or ''."""
    return F.coalesce(F.nullif(F.col("canonical_url"), F.lit("")), F.col("url"))


def curated_order() -> list[Column]:
    """Best first, newest first among equals; total by article id."""
    return [F.desc("relevance_score"), F.desc("event_ts"), F.asc("article_id")]


def rank_value() -> Column:
    """Higher scores first, with all their digits and of any size; a missing
    score and one that is no number rank like 0."""
    return F.lit(0.0) - F.coalesce(F.nanvl(F.col("relevance_score").cast("double"), F.lit(0.0)),
                                   F.lit(0.0))


def tie_value() -> Column:
    """Order among equal scores: earlier date (undated first), then article id."""
    day = F.coalesce(F.unix_date("published_date"), F.lit(-1000000)) + 1000000
    return F.concat(F.lpad(day.cast("string"), 8, "0"), F.lit("/"), F.col("article_id"))


def select_top(df: DataFrame, top_n: int = TOP_STORIES,
               markets: Iterable[str] | None = None, collapse: bool = True) -> DataFrame:
    """Stories of a briefing, best first.

    Retellings are dropped before the cut, so the next distinct story moves
    up.  Only the first blocks of the ranking are compared, however large the
    table is.
    """
    rows = any_market(df, markets)
    ranked = rows.withColumns({"_rank": rank_value(), "_tie": tie_value()})
    if collapse:
        named = ranked.select(F.lit(0).alias("_all"), F.col("_tie").alias("article_id"), "_rank",
                              "title", "summary")
        kept = first_distinct(named, "_all", "_rank", top_n)
        ranked = ranked.join(kept.select(F.col("article_id").alias("_tie")), "_tie", "left_semi")
    return ranked.orderBy("_rank", "_tie").limit(top_n).drop("_rank", "_tie")


def number_stories(stories: DataFrame) -> DataFrame:
    """Add ``rank`` 1..n in briefing order.  For selections of bounded size."""
    window = Window.orderBy(rank_value(), tie_value())
    return stories.withColumn("rank", F.row_number().over(window))


def with_batches(stories: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Add the number of the batch a ranked story belongs to."""
    return stories.withColumn("batch", F.ceil(F.col("rank") / size).cast("int"))


def digest(df: DataFrame, top_n: int = TOP_DIGEST, market: str | None = None) -> DataFrame:
    """Best articles with display tags."""
    return (one_market(df, market).orderBy(*curated_order()).limit(top_n).select(
        "article_id", "title", "relevance_score", "primary_market", "source_name",
        F.coalesce(F.date_format("published_date", "yyyy-MM-dd"), F.lit("?")).alias("published_date"),
        F.coalesce(F.nullif(F.array_join("esg_pillars", "/"), F.lit("")), F.lit("-")).alias("tags"),
        F.coalesce(F.array_join("regulations", ", "), F.lit("")).alias("regulation_names"),
        best_url().alias("link")))


def slim(df: DataFrame) -> DataFrame:
    """The few fields a browse page needs, under short names."""
    def some(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast("array<string>"))

    return df.select(
        F.col("title").alias("t"), best_url().alias("u"),
        F.col("source_name").alias("s"), F.col("source_type").alias("st"),
        F.date_format("published_date", "yyyy-MM-dd").alias("d"),
        F.col("primary_market").alias("m"), some("esg_pillars").alias("p"),
        some("topics").alias("tp"), some("regulations").alias("r"),
        F.round(F.coalesce("relevance_score", F.lit(0.0)), 3).alias("sc"),
        F.substring(F.coalesce("summary", F.lit("")), 1, 320).alias("sm"))


def browse(rows: DataFrame, sort: str = "score") -> DataFrame:
    """Slim rows by score then date, or by date then score."""
    by_score, by_date = F.desc("sc"), F.desc(F.coalesce("d", F.lit("")))
    first, second = (by_date, by_score) if sort == "date" else (by_score, by_date)
    return rows.orderBy(first, second, "u")


def stringify_times(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, for text exports."""
    return df.withColumns({name: F.col(name).cast("string") for name, kind in df.dtypes
                           if kind in ("timestamp", "date")})
