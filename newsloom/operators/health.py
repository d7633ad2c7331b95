"""Feed health and ingest statistics from the fetch log and landed items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import FORWARD_SKEW


def outcome() -> Column:
    """What one fetch came to: ``not_modified``, ``failed`` or ``ok``."""
    return (F.when(F.col("not_modified"), F.lit("not_modified"))
            .when(F.col("error").isNotNull() | ~F.col("has_body"), F.lit("failed"))
            .otherwise(F.lit("ok")))


def last_fetches(log: DataFrame, *keys: str) -> DataFrame:
    """The last attempt per key.  Later attempts are retries and replace
    earlier ones; the body itself is not carried along."""
    attempt = F.struct(
        F.col("feed_url"), F.col("error"),
        F.coalesce("not_modified", F.lit(False)).alias("not_modified"),
        F.col("body").isNotNull().alias("has_body"))
    order = F.struct("fetched_at", F.coalesce("error", F.lit("")), "status")
    return (log.groupBy(*keys)
            .agg(F.max_by(attempt, order).alias("_last"), F.min("fetched_at").alias("started_at"))
            .select(*keys, "started_at", "_last.*")
            .withColumn("outcome", outcome()).drop("has_body", "not_modified"))


def feed_health(registry: DataFrame, log: DataFrame, items: DataFrame) -> DataFrame:
    """State of every registered feed: FAIL, OK (has items) or EMPTY.

    ``items`` has (source_id, published_at).  Feeds that were never fetched
    are reported as failed.
    """
    fetches = last_fetches(log, "source_id").select(
        "source_id", F.col("outcome"), F.col("error").alias("_error"))
    counts = items.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("_items"), F.count("published_at").alias("_dated"),
        F.max("published_at").alias("_newest"))
    failed = F.coalesce("outcome", F.lit("failed")) == "failed"
    return (registry.select(F.col("id").alias("source_id"), "name", "market", "url")
            .join(fetches, "source_id", "left").join(counts, "source_id", "left")
            .select("source_id", "name", "market", "url",
                    F.when(failed, F.lit("FAIL"))
                    .when(F.coalesce("_items", F.lit(0)) > 0, F.lit("OK"))
                    .otherwise(F.lit("EMPTY")).alias("status"),
                    F.when(failed, 0).otherwise(F.coalesce("_items", F.lit(0))).cast("bigint").alias("items"),
                    F.when(~failed, F.coalesce("_dated", F.lit(0))).cast("bigint").alias("dated_items"),
                    F.when(~failed, F.col("_newest")).alias("newest"),
                    F.when(failed, F.coalesce("_error", F.lit("not fetched"))).alias("error")))


def health_report(health: DataFrame) -> DataFrame:
    """Healthy feeds first, then by feed id."""
    return health.orderBy(F.col("status") != "OK", "source_id")


def healthy_total(health: DataFrame) -> DataFrame:
    """How many of the feeds are healthy."""
    return health.agg(F.count_if(F.col("status") == "OK").alias("healthy"),
                      F.count(F.lit(1)).alias("feeds"))


def feed_stats(log: DataFrame, items: DataFrame, days: int) -> DataFrame:
    """One row per run and feed.

    ``log`` and ``items`` carry ``run_id``; ``items`` has (source_id,
    published_ts).  The window of a run ends when the run started, plus the
    allowance for clocks that are ahead.
    """
    fetches = last_fetches(log, "run_id", "source_id")
    runs = log.groupBy("run_id").agg(F.min("fetched_at").alias("run_started"))
    # One row per run: adaptive execution broadcasts it once it has seen the size.
    skew = F.make_dt_interval(hours=F.lit(int(FORWARD_SKEW.total_seconds() // 3600)))
    published = F.col("published_ts")
    inside = published.isNull() | published.between(
        F.col("run_started") - F.make_dt_interval(days=F.lit(days)), F.col("run_started") + skew)
    counts = (items.join(runs, "run_id")
              .groupBy("run_id", "source_id")
              .agg(F.count(F.lit(1)).alias("_parsed"), F.count_if(inside).alias("_kept")))
    ok = F.col("outcome") == "ok"
    return (fetches.join(counts, ["run_id", "source_id"], "left")
            .select("run_id", "source_id", "feed_url", "outcome",
                    F.when(ok, F.coalesce("_parsed", F.lit(0))).cast("bigint").alias("articles_parsed"),
                    F.when(ok, F.coalesce("_kept", F.lit(0))).otherwise(0).cast("bigint").alias("articles"),
                    F.when(F.col("outcome") == "failed", F.col("error")).alias("error")))


def run_stats(stats: DataFrame) -> DataFrame:
    """Totals per run, with its failures (at most one per feed)."""
    failed = F.col("outcome") == "failed"
    return stats.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("feeds_requested"),
        F.count_if(F.col("outcome") == "ok").alias("feeds_ok"),
        F.count_if(F.col("outcome") == "not_modified").alias("feeds_not_modified"),
        F.count_if(failed).alias("feeds_failed"),
        F.coalesce(F.sum("articles_parsed"), F.lit(0)).alias("articles_parsed"),
        F.sum("articles").alias("articles_in_window"),
        F.array_sort(F.collect_list(F.when(failed, F.struct(
            "source_id", F.col("feed_url").alias("url"), "error")))).alias("failures"))
