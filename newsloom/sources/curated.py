"""Curated table, rollups and run statistics on disk."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rollups import build_rollups
from ..schemas import CURATED_COLUMNS, LIST_COLUMNS


def write_curated(df: DataFrame, path: str, ingest_date: date) -> str:
    """Write one day of curated articles as Parquet, by market.

    Only that day's folder is replaced, as a whole: other days stay, and a
    second run that has no rows for a market leaves no old ones behind.  The day
    is written beside the old one, in a folder that readers pass over, and put in
    its place when it is whole; a write that fails leaves the old day as it was.
    """
    root, spark, mark = path.rstrip("/"), df.sparkSession, uuid.uuid4().hex
    target = f"{root}/ingest_date={ingest_date.isoformat()}"
    beside, before = f"{root}/_writing-{mark}", f"{root}/_replaced-{mark}"
    day, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, beside, before))
    files = day.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        (df.drop("ingest_date").write.partitionBy("primary_market")
         .option("compression", "snappy").parquet(beside))
        replaces = files.exists(day)
        if replaces and not files.rename(day, old):
            raise OSError(f"{target} could not be moved aside")
        if not files.rename(new, day):
            if replaces:
                files.rename(old, day)
            raise OSError(f"{beside} could not be moved to {target}")
    finally:
        files.delete(new, True)  # what a failed write left
    files.delete(old, True)
    return target


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """All curated days; filters on day and market prune folders."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.withColumn("ingest_date", F.col("ingest_date").cast("date")).select(*CURATED_COLUMNS)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Curated articles as JSON lines."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


#: Quotes doubled, white space and line breaks of texts kept.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}


def csv_rows(df: DataFrame) -> DataFrame:
    """Lists joined with ``|``, as CSV holds no arrays."""
    return df.withColumns({c: F.coalesce(F.array_join(c, "|"), F.lit("")) for c in LIST_COLUMNS})


def write_csv(df: DataFrame, path: str) -> None:
    """Curated articles as CSV with a header line."""
    csv_rows(df).write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV export, every column as text; an empty cell of a list is an empty list."""
    rows = spark.read.options(multiLine=True, **_CSV).csv(path)
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in LIST_COLUMNS})


def write_rollups(curated: DataFrame, path: str) -> dict[str, str]:
    """One Parquet dataset per rollup; returns where each one went.

    ``curated`` should be the stored table, so that it is not computed anew
    for every rollup.
    """
    out = {}
    for name, df in build_rollups(curated).items():
        out[name] = f"{path.rstrip('/')}_rollup_{name}"
        df.write.mode("overwrite").parquet(out[name])
    return out


def append_stats(feed_stats: DataFrame, run_stats: DataFrame, path: str) -> None:
    """Append the statistics of runs, one row per run and per feed."""
    feed_stats.write.mode("append").parquet(f"{path.rstrip('/')}/feed_stats")
    run_stats.write.mode("append").parquet(f"{path.rstrip('/')}/run_stats")
