"""Incremental curation: tag newly landed files once, curate when needed.

Tagging is the expensive part and looks at one row at a time, so a stream does
it as files arrive and appends to the prepared table.  Winners are not kept
up to date in place: when the copy that won a URL leaves the window, another
one inside it must come back, and group sizes cannot be rebuilt from winners.
So the window and the duplicate removal run as a batch over the prepared rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..lexicon import DEFAULT_LEXICON, Lexicon
from ..operators.enrichment import Scorer, points_scorer
from ..operators.filters import FORWARD_SKEW, GATE_THRESHOLD, utc
from ..plans.curate import finish, prepare
from ..sources.landing import LANDING_SCHEMA, OPTIONS, raw_rows


def prepare_new_files(spark: SparkSession, landing: str, prepared: str, checkpoint: str,
                      lexicon: Lexicon = DEFAULT_LEXICON, scorer: Scorer = points_scorer,
                      min_relevance: float = GATE_THRESHOLD,
                      max_files: int = 10000) -> StreamingQuery:
    """Tag all files that have landed since the last call and stop.

    The prepared table is partitioned by publication day; undated rows have
    the NULL partition.  File sink and checkpoint make every row appear once.
    """
    stream = (spark.readStream.schema(LANDING_SCHEMA).options(**OPTIONS)
              .option("maxFilesPerTrigger", max_files).json(landing))
    rows = prepare(raw_rows(stream), lexicon, scorer, min_relevance)
    return (rows.withColumn("published_day", F.to_date("published_ts"))
            .writeStream.format("parquet").outputMode("append")
            .option("path", prepared).option("checkpointLocation", checkpoint)
            .partitionBy("published_day").trigger(availableNow=True).start())


def curate_prepared(spark: SparkSession, prepared: str, as_of: datetime | str, days: int = 7,
                    undated_max_age_days: int | None = None) -> DataFrame:
    """Curated articles from the prepared table; reads only the days of the
    window and the undated partition."""
    now = utc(as_of)
    first, last = (now - timedelta(days=days)).date(), (now + FORWARD_SKEW).date()
    day = F.col("published_day")
    rows = spark.read.parquet(prepared).filter(
        day.isNull() | day.between(F.lit(first), F.lit(last)))
    return finish(rows.drop("published_day"), as_of, days, undated_max_age_days)
