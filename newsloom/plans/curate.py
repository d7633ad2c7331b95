"""Raw articles to the curated table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lexicon import DEFAULT_LEXICON, Lexicon
from ..operators import dedupe
from ..operators.enrichment import (Scorer, enrich, points_scorer,
                                    primary_market, require_fields,
                                    with_timestamps)
from ..operators.filters import (GATE_THRESHOLD, in_window, is_relevant,
                                 lit_timestamp, not_expired, utc)
from ..schemas import CURATED_COLUMNS
from ..session import cut_lineage


def prepare(raw: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON,
            scorer: Scorer = points_scorer,
            min_relevance: float = GATE_THRESHOLD) -> DataFrame:
    """The part that looks at one row at a time and does not depend on the
    clock: required fields, tags, score, gate.  Works on streams too."""
    rows = enrich(with_timestamps(require_fields(raw)), lexicon, scorer)
    return rows.filter(is_relevant(min_relevance))


def recent(df: DataFrame, as_of: datetime | str, days: int,
           undated_max_age_days: int | None = None) -> DataFrame:
    """Rows of the trailing window."""
    return df.filter(in_window(F.col("published_ts"), as_of, days)
                     & not_expired(as_of, undated_max_age_days))


def with_event_time(df: DataFrame, as_of: datetime | str) -> DataFrame:
    """Event time and date; rows without any usable time get ``as_of``."""
    return df.withColumn(
        "event_ts", F.coalesce("published_ts", "fetched_ts", lit_timestamp(as_of))
    ).withColumn("published_date", F.to_date("event_ts"))


def finish(prepared: DataFrame, as_of: datetime | str, days: int = 7,
           undated_max_age_days: int | None = None) -> DataFrame:
    """Window, duplicate removal and final columns over prepared rows."""
    rows = recent(prepared, as_of, days, undated_max_age_days)
    rows = dedupe.by_title_and_day(dedupe.by_url(with_event_time(rows, as_of)))
    return rows.withColumns({
        "primary_market": primary_market(),
        "ingest_date": F.lit(utc(as_of).date()),
    }).select(*CURATED_COLUMNS)


def curate(raw: DataFrame, as_of: datetime | str, days: int = 7,
           min_relevance: float = GATE_THRESHOLD,
           lexicon: Lexicon = DEFAULT_LEXICON, scorer: Scorer = points_scorer,
           undated_max_age_days: int | None = None) -> DataFrame:
    """Curated articles of the trailing window.

    The window test comes first, so rows outside it are never tagged.  What a
    model has scored is stored before duplicates are removed, so that it is called
    once a row, however often the rows are read and whatever is lost later.
    """
    rows = recent(with_timestamps(require_fields(raw)), as_of, days, undated_max_age_days)
    rows = enrich(rows, lexicon, scorer).filter(is_relevant(min_relevance))
    if getattr(scorer, "runs_python", False):
        rows = cut_lineage(rows, "scored")
    return finish(rows, as_of, days, undated_max_age_days)
