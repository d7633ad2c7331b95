"""Mixing sources to target weights.

Tokens (words) are aggregated per source, which gives each source a target and
a repetition rate; every document is then taken ``floor(rate)`` times, and once
more with the probability of the rate's fraction, decided by a hash of its id.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; a source of size 0 has target 0 and takes nothing; documents that
share an id (null included) draw by id and place of the row in the table, each
for itself, so reruns over the same stored table and settings agree for them
too; an empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from ..session import cut_lineage
from .common import WORD, text_of


@dataclass(frozen=True)
class Mix:
    """weights: of the sources in code-point order, repeating; limit: most
    repetitions of a source; seed: of the draws."""

    weights: Sequence[float] = (1, 2, 3)
    limit: int = 3
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1), fixed by key and seed: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(
        float(2**52))


def source_targets(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source_size`` and ``target`` per source, from rows of (no_source, source, size).

    A target is ``min(limit * size, level * weight)``; the level at which targets
    add up to all sizes is found by taking sources at their limit out and
    sharing what is left among the others, until none is above.  Each step
    reads two sums over the sources, never the sources themselves.
    """
    totals = sized.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    sources = cut_lineage(
        numbered(totals, ["no_source", "source"], "sources").withColumn(
            "weight", F.element_at(weights, (F.col("position") % len(mix.weights) + 1)
                                   .cast("int"))).drop("position"), "source-weights")
    top = F.col("source_size") * mix.limit
    level, full = 0.0, -1
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while total:
        at_limit = top <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.count(F.when(at_limit, 1)).alias("full"),
            F.sum(F.when(at_limit, top).otherwise(0)).alias("fixed"),
            F.sum(F.when(at_limit, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if row.full == full or not row.open:
            break
        full, level = row.full, (total - row.fixed) / row.open
    return sources.select(
        "no_source", "source", "source_size",
        F.least(top.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def repeated_ids(docs: DataFrame, id_column: str) -> DataFrame:
    """Ids (``again``) that more than one row has: one narrow aggregate."""
    again = (docs.groupBy(F.col(id_column).alias("again")).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("again"))
    return cut_lineage(again, "repeated-ids")


def with_copies(docs: DataFrame, mix: Mix = Mix(), id_column: str = "doc_id",
                text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Columns ``row`` (the document, all columns), ``size``, ``source_size``,
    ``target`` and ``copies`` for every document."""
    def sized(*kept: Column) -> DataFrame:
        return docs.select(
            *kept, F.col(source_column).isNull().alias("no_source"),
            F.coalesce(F.col(source_column), F.lit("")).alias("source"),
            word_count(text_of(text_column)).alias("size"))

    targets = source_targets(sized(), mix)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    again = repeated_ids(docs, id_column)
    own = F.col("row")[id_column]
    if again.isEmpty():
        rows, key = sized(row), own.cast("string")
    else:
        rows = sized(row, F.monotonically_increasing_id().alias("place"))
        rows = rows.join(again.withColumn("shared", F.lit(True)), own.eqNullSafe(F.col("again")), "left")
        key = F.when(F.col("shared"), F.concat_ws(":", F.coalesce(own.cast("string"), F.lit("null")),
                                                  "place")).otherwise(own.cast("string"))
    more = draw(key, mix.seed) < F.col("rate") - F.floor("rate")
    return (rows.join(targets, ["no_source", "source"])
            .withColumn("rate", rate)
            .select("row", "size", "source_size", "target",
                    (F.floor("rate") + more.cast("int")).cast("int").alias("copies")))


def mixed(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """The mix itself: the documents with all their columns, repeated."""
    return (with_copies(docs, mix, **columns).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("row.*"))


def report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: its size, its source's size and target, words taken."""
    narrow = docs.select("doc_id", "text", "source")
    return with_copies(narrow, mix).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source),
total AS (SELECT sum(source_size) AS t, sum(weight) AS w FROM s),
o AS (
  SELECT 3 * source_size / weight AS ratio, sum(3 * source_size) OVER w AS fixed,
         sum(weight) OVER w AS taken, lead(3 * source_size / weight) OVER w AS after
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
steps AS (
  SELECT 0 AS fixed, w AS open, 0.0 AS ratio, (SELECT min(ratio) FROM o) AS after FROM total
  UNION ALL SELECT fixed, w - taken, ratio, after FROM o, total),
level AS (
  SELECT coalesce(min((t - fixed) / open), 0.0) AS level FROM steps, total
  WHERE open > 0 AND t > 0 AND (t - fixed) / open BETWEEN ratio AND after),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target,
         CASE WHEN source_size > 0 THEN least(CAST(3 * source_size AS DOUBLE), weight * level) / source_size
              ELSE 0.0 END AS rate
  FROM s, level)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
                    / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source
"""
