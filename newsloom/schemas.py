"""Fixed schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

RAW_COLUMNS = (
    "article_id", "title", "url", "canonical_url", "summary", "author",
    "published_at", "published_raw", "categories", "source_id",
    "source_name", "source_market", "source_type", "language", "feed_url",
    "fetched_at",
)
RAW_SCHEMA = T.StructType([
    T.StructField(c, T.ArrayType(_S) if c == "categories" else _S)
    for c in RAW_COLUMNS
])

# Column of a landing scan that holds the text of a line that is no valid row.
CORRUPT_COLUMN = "_corrupt_record"

FETCH_LOG_SCHEMA = T.StructType([
    T.StructField("source_id", _S),
    T.StructField("feed_url", _S),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.BinaryType()),
    T.StructField("error", _S),
    T.StructField("not_modified", T.BooleanType()),
    T.StructField("fetched_at", T.TimestampType()),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField(c, _S) for c in
    ("id", "name", "url", "market", "source_type", "language", "via")
])

# What the XML splitter hands over: strings exactly as they stand in the feed.
FEED_ITEM_SCHEMA = T.StructType([
    T.StructField("source_id", _S),
    T.StructField("feed_url", _S),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("title_text", _S),
    T.StructField("link", _S),
    T.StructField("body_text", _S),
    T.StructField("date_text", _S),
    T.StructField("author", _S),
    T.StructField("labels", T.ArrayType(_S)),
    T.StructField("publisher", _S),
])

CURATED_COLUMNS = (
    "article_id", "title", "url", "canonical_url", "summary", "author",
    "source_id", "source_name", "source_type", "source_market", "language",
    "published_ts", "published_date", "fetched_ts", "has_publish_date",
    "categories", "esg_pillars", "topics", "regulations", "markets",
    "is_eu", "is_us", "primary_market", "relevance_score",
    "duplicate_count", "feed_url", "event_ts", "ingest_date",
)
LIST_COLUMNS = ("categories", "esg_pillars", "topics", "regulations", "markets")
