"""The append-only landing zone of raw articles: JSON lines under
``ingest_date=…/run_id=…``."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_datetime
from ..operators.filters import in_window
from ..schemas import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA

SCAN_SCHEMA = T.StructType([
    *RAW_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
# Partition columns stated, not guessed: a run id of digits stays text.
LANDING_SCHEMA = T.StructType([
    *SCAN_SCHEMA.fields, T.StructField("ingest_date", T.DateType()),
    T.StructField("run_id", T.StringType())])
OPTIONS = {"pathGlobFilter": "*.jsonl", "mode": "PERMISSIVE",
           "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_landing(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """All runs of a landing zone, with their partition columns.

    Only ``*.jsonl`` files are read.  A line that is no valid row arrives with
    its text in the corrupt column and everything else NULL.  ``since`` prunes
    to folders landed from that day on; it is the caller's choice, as undated
    articles of older runs are then not seen.
    """
    rows = spark.read.schema(LANDING_SCHEMA).options(**OPTIONS).json(path)
    return rows if since is None else rows.filter(F.col("ingest_date") >= F.lit(since))


def raw_rows(landing: DataFrame) -> DataFrame:
    """The valid rows of a landing scan in raw shape."""
    return landing.filter(F.col(CORRUPT_COLUMN).isNull()).select(*RAW_COLUMNS)


def quarantine_counts(landing: DataFrame) -> DataFrame:
    """Lines, corrupt lines and rows with a URL per run."""
    return landing.groupBy("ingest_date", "run_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count(CORRUPT_COLUMN).alias("corrupt"),
        F.count("url").alias("with_url"))


def quarantine(landing: DataFrame) -> DataFrame:
    """Every line that is no valid row, with where it came from.

    ``landing`` must be the scan itself.  ``block_start`` is the offset of the
    part of the file that the line was read with; ``article_id`` is given where
    it could still be read.
    """
    return (landing.select(
        "ingest_date", "run_id", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"), "article_id",
        F.col(CORRUPT_COLUMN).alias("line"))
        # Spark fills the line only if a column of the file is read with it.
        .filter(F.col("line").isNotNull() & F.coalesce("article_id", "line").isNotNull()))


def from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """In-memory rows (tests, small drops) as a raw table."""
    return spark.createDataFrame(
        [tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def keep_window(articles: DataFrame, as_of: datetime | str, days: int) -> DataFrame:
    """Articles of the trailing window, undated ones included."""
    return articles.filter(in_window(parse_datetime(F.col("published_at")), as_of, days))


def land(articles: DataFrame, path: str) -> None:
    """Append articles that carry ``ingest_date`` and ``run_id``.

    Files end in ``.jsonl``; arrays stay arrays and NULL fields are kept.  The
    CSV writer, without quoting, is used as a plain line writer, because it is
    the one that lets the file extension be chosen.
    """
    columns = [*RAW_COLUMNS, "ingest_date", "run_id"]
    line = F.to_json(F.struct(*[F.col(c) for c in RAW_COLUMNS]), {"ignoreNullFields": "false"})
    (articles.select(*columns).select(line.alias("value"), "ingest_date", "run_id")
     .write.mode("append").partitionBy("ingest_date", "run_id")
     .format("csv").options(quote="", sep="\x01", header="false", extension="jsonl")
     .save(path))
