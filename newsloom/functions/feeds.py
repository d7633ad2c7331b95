"""Small rules for text that comes out of feed items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_publisher_suffix(title: Column, publisher: Column) -> Column:
    """Headline without the `` - publisher`` tail a relay feed appends.

    Without a publisher to compare with, a short tail is cut only if it looks
    like a source: it has a dot or at most four words.
    """
    tail_at_end = title.endswith(F.concat(F.lit(" - "), publisher))
    named = F.trim(F.substring(title, F.lit(1),
                               F.length(title) - F.length(publisher) - F.lit(3)))
    pattern = r"(?sU)^(.*?)\s+-\s+([^-]{2,40})$"
    tail = F.trim(F.regexp_extract(title, pattern, 2))
    looks_like_source = F.contains(tail, F.lit(".")) | (F.size(F.split(tail, r"(?U)\s+")) <= 4)
    return (F.when((F.coalesce(publisher, F.lit("")) != "") & tail_at_end, named)
            .when((tail != "") & looks_like_source,
                  F.trim(F.regexp_extract(title, pattern, 1)))
            .otherwise(title))
