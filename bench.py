"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (timed runs per query, 1; the median counts), BENCH_QUERIES (names separated by commas),
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "canonical_urls", "html_text", "feed_dates", "feed_items", "regulation_tags",
    "relevance_scores", "window_filter", "url_dedupe", "title_dedupe", "curated_articles",
    "market_day", "site_stats", "digest_top25", "section_routing", "token_signatures",
    "near_dup_collapse", "briefing_top20", "feed_health", "ingest_stats", "report_text",
    "report_audit", "term_counts", "landing_round_trip", "incremental_curation",
)


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("newsloom-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("newsloom.scan.partitions", cpus)  # the given tables are single files
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    from newsloom.plans import catalog
    timed(lambda: catalog.QUERIES["market_day"](spark, sf_dir))  # start workers, compile
    seconds = {}
    for name in names:
        query = catalog.QUERIES[name]
        seconds[name] = round(statistics.median(
            timed(lambda: query(spark, sf_dir)) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
              "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}
    if os.environ.get("BENCH_COMPARE") == "1":
        from benchmarks import comparisons
        result["comparisons"] = comparisons.run(spark, sf_dir)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
