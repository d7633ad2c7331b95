"""Duplicate removal by URL and by headline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Headlines with shorter keys say too little to count as the same story.
MIN_TITLE_KEY = 15


def precedence() -> list[Column]:
    """Which copy of an article wins: regulators first, then the higher score,
    then the earlier event; the remaining keys make the order total."""
    regulator_first = F.when(F.col("source_type") == "regulator", 0).otherwise(1)
    return [
        regulator_first.alias("a"), (-F.col("relevance_score")).alias("b"),
        F.col("event_ts"), F.col("article_id"), F.col("source_id"),
        F.col("url"), F.col("fetched_ts"),
        F.md5(F.concat_ws("\n", "title", "summary")).alias("c"),
    ]


#: Parts that the sizes of short headline groups are repeated in, so that the
#: rows of one (an empty headline, say) spread over as many tasks.
SPREAD = 32


def by_url(df: DataFrame) -> DataFrame:
    """Best row per de-duplication key.

    One aggregate that combines on the map side: a key that holds a large share
    of all rows sends one row per task.  The row travels as one value, so every
    reading of the result, however few columns it takes, has the same shuffle,
    and Spark runs it once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "dedupe_key"])
    best = df.groupBy("dedupe_key").agg(F.min_by(row, F.struct(*precedence())).alias("_best"))
    return best.select(*[F.col("dedupe_key") if c == "dedupe_key" else F.col(f"_best.`{c}`")
                         for c in df.columns])


def by_title_and_day(df: DataFrame, min_key: int = MIN_TITLE_KEY) -> DataFrame:
    """Best row per headline and day, with ``duplicate_count``.

    Expects one row per ``dedupe_key``, as ``by_url`` gives it.  Only narrow rows
    (keys and precedence) are ranked: one aggregate, combined on the map side,
    gives the size of every group and the winner of long headlines, so a headline
    copied everywhere is no hot spot.  Rows with a short headline all survive and
    take the size of their group, which is repeated in ``SPREAD`` parts.  The
    survivors are joined back once, by the key that whole rows already lie by.
    """
    order = F.struct(*precedence())
    narrow = df.select("dedupe_key", "title_key", "published_date", order.alias("_order"))
    groups = narrow.groupBy("title_key", "published_date").agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.min_by("dedupe_key", "_order").alias("_winner"))
    short = F.length("title_key") < min_key
    parts = F.pmod(F.xxhash64("dedupe_key"), F.lit(SPREAD)).cast("int")
    sizes = groups.where(short).where("duplicate_count > 1").select(
        "title_key", "published_date", "duplicate_count",
        F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_part"))
    everyone = (narrow.where(short).select("dedupe_key", "title_key", "published_date",
                                           parts.alias("_part"))
                .join(sizes, ["title_key", "published_date", "_part"], "left")
                .select("dedupe_key", F.coalesce("duplicate_count", F.lit(1)).alias("duplicate_count")))
    winners = groups.where(~short).select(F.col("_winner").alias("dedupe_key"), "duplicate_count")
    return df.join(winners.unionByName(everyone), "dedupe_key").select(*df.columns, "duplicate_count")
