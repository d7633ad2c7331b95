"""I-Match fingerprints with randomised lexicon subsets.

Terms are lower-cased runs of letters and digits.  Document frequencies over
all documents give the lexicon: terms whose frequency lies within a band of
shares of all documents (so within a band of inverse document frequency).  Of
each text the distinct terms in the lexicon are kept and sorted, and hashed
once for each of several subsets of the lexicon.  Subsets are dense (a quarter
of the lexicon) to sparse (1/256), so that fingerprints of close texts agree in
most subsets, and those of looser ones in the sparse subsets only.  A text
without any term in the band is described by all its terms.

The lexicon is bounded: each term is in at least ``low`` of all documents, so
there are at most (mean distinct terms of a document) / ``low`` of them,
whatever the number of documents.  Up to ``LITERAL_TERMS`` it travels as a
constant of the plan; beyond, terms are joined with it.

Defined cases: a null text is empty; texts without terms have an empty
fingerprint, and two of them have likeness 1; equal texts have equal
fingerprints; a null id sorts before all others, as the least possible id; rows
with the same id follow each other in the order of their text hashes; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import text_of

#: Characters between terms: ASCII signs, general punctuation, no-break and wide space.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F  -⁯　]+"
LITERAL_TERMS = 50_000
#: Text in one of the ranges that documents are put in order by.
RANGE_BYTES = 16 << 20
#: Ranges at most: their starts are a few MB in the plan.
MAX_RANGES = 1 << 16


@dataclass(frozen=True)
class Band:
    """Shares of all documents between which a term's document frequency lies."""

    low: float = 0.01
    high: float = 0.2


def subsets() -> list[tuple[int, int]]:
    """(mask, value) of each subset: it holds the terms whose hash has ``value``
    under ``mask``.  Masks of 2, 4, 6 and 8 bits of their own: subsets of 1/4,
    1/16, 1/64 and 1/256 of the lexicon."""
    out, first = [], 0
    for width, count in ((2, 4), (4, 8), (6, 12), (8, 24)):
        out += [(((1 << width) - 1) << first, value << first) for value in range(count)]
        first += width
    return out


def distinct_terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.array_distinct(F.split(F.lower(text), BETWEEN))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, band: Band = Band(), text_column: str = "text") -> DataFrame:
    """(term, frequency) of the terms within the band, over all documents."""
    total = docs.count()
    return (docs.select(F.explode(distinct_terms(text_of(text_column))).alias("term"))
            .groupBy("term").agg(F.count("*").alias("frequency"))
            .where(F.col("frequency").between(band.low * total, band.high * total)))


def _in_lexicon(texts: DataFrame, terms: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each text column by its sorted terms; all terms if none is in the
    band.  ``terms`` is a stored table."""
    size = terms.count()
    if size <= LITERAL_TERMS:
        known = json.dumps(sorted(r.term for r in terms.collect()))
        literal = F.from_json(F.lit(known), "array<bigint>")
        for name in columns:
            texts = texts.withColumn(f"_{name}_all", distinct_terms(F.col(name))).drop(name)
            texts = texts.withColumn(name, F.array_intersect(f"_{name}_all", literal))
    else:
        for name in columns:
            texts = texts.withColumn(f"_{name}_key", F.sha2(name, 256)).withColumn(
                f"_{name}_all", distinct_terms(F.col(name))).drop(name)
            found = (texts.select(F.col(f"_{name}_key").alias("_key"),
                                  F.explode(f"_{name}_all").alias("term"))
                     .join(terms, "term").groupBy("_key").agg(F.collect_set("term").alias(name)))
            texts = texts.join(found, F.col(f"_{name}_key") == F.col("_key"), "left").drop(
                "_key", f"_{name}_key")
    for name in columns:
        banded = F.coalesce(F.col(name), F.array().cast("array<bigint>"))
        texts = texts.withColumn(name, F.array_sort(
            F.when(F.size(banded) > 0, banded).otherwise(F.col(f"_{name}_all")))).drop(f"_{name}_all")
    return texts


def hashed_subsets(terms: Column) -> Column:
    """One hash of the sorted terms for each subset; null where it holds none."""
    def part(mask: int, value: int) -> Column:
        own = F.filter(terms, lambda h: h.bitwiseAND(F.lit(mask)) == F.lit(value))
        return F.when(F.size(own) > 0, F.hash(own))

    return F.array(*[part(mask, value) for mask, value in subsets()])


def fingerprint(parts: Column) -> Column:
    """The parts as one string, eight hexadecimal digits each."""
    return F.array_join(F.transform(parts, lambda p: F.coalesce(
        F.lower(F.lpad(F.hex(p.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")),
        F.lit("--------"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of subsets, held by either text, whose hashes agree."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)),
                             lambda e: e.isNotNull()))
    return F.when(either > 0, same / either).otherwise(1.0)


def with_prints(texts: DataFrame, columns: dict[str, str], terms: DataFrame) -> DataFrame:
    """Add the parts of the fingerprint of each text column, under a new name."""
    copies = texts.withColumns({new: F.col(old) for old, new in columns.items()})
    out = _in_lexicon(copies, terms, list(columns.values()))
    return out.withColumns({new: hashed_subsets(F.col(new)) for new in columns.values()})


@dataclass(frozen=True)
class Ranges:
    """Where ranges of rows in the order of (id, hash) begin.  There are at most
    ``MAX_RANGES``, whatever the number of documents.  Their starts lie in pages
    of about the square root of their number, so a row is compared with two pages
    and not with all of them."""

    starts: list[dict]
    kind: str

    @property
    def page(self) -> int:
        return max(1, math.isqrt(len(self.starts)))

    def place(self) -> tuple[Column, Column]:
        """The number of the range of (id, hash), and whether the row is its start."""
        pages = [self.starts[k:k + self.page] for k in range(0, len(self.starts), self.page)]
        start = f"struct<id:{self.kind},hash:bigint>"
        heads = F.from_json(F.lit(json.dumps([p[0] for p in pages])), f"array<{start}>")
        rest = F.from_json(F.lit(json.dumps(pages)), f"array<array<{start}>>")
        own = F.struct("id", "hash")
        page = F.size(F.filter(heads, lambda b: b <= own))
        inner = F.element_at(rest, page)
        inside = F.size(F.filter(inner, lambda b: b <= own))
        return (page - 1) * self.page + inside - 1, F.element_at(inner, inside) == own


def _ranges(rows: DataFrame, range_bytes: int) -> Ranges:
    """Ranges of about ``range_bytes`` of text, larger ones where that would make
    more than ``MAX_RANGES``."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = min(MAX_RANGES, max(1, -(-total // range_bytes)))
    keys = rows.select("id", "hash").repartitionByRange(wanted, "id", "hash")
    starts = (keys.groupBy(F.spark_partition_id().alias("range"))
              .agg(F.min(F.struct("id", "hash")).alias("start")).select("start.*").collect())
    return Ranges([{"id": r.id, "hash": r.hash} for r in sorted(starts, key=tuple)],
                  rows.schema["id"].dataType.simpleString())


def followed(rows: DataFrame, ranges: Ranges, carried: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the row that follows in the order of (id, hash);
    the first row follows the last.

    Texts are shuffled once, to the range they lie in; within a range the next
    row is at hand, and the last one takes the first row of the next range.
    """
    number, is_start = ranges.place()
    placed = rows.withColumn("range", number)
    order = Window.partitionBy("range").orderBy("id", "hash")
    ahead = placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}
                               | {"_last": F.lead("id").over(order).isNull()})
    # As many rows as there are ranges.
    heads = (rows.where(is_start)
             .withColumn("range", F.pmod(number - 1, F.lit(max(len(ranges.starts), 1))))
             .dropDuplicates(["range"]).select(
                 F.col("range").alias("_range"), *[F.col(c).alias(f"_head_{c}") for c in carried]))
    return (ahead.join(heads, F.col("range") == F.col("_range"))
            .withColumns({f"next_{c}": F.when(F.col("_last"), F.col(f"_head_{c}"))
                          .otherwise(F.col(f"next_{c}")) for c in carried})
            .drop("_range", "_last", "range", *[f"_head_{c}" for c in carried]))


def report(docs: DataFrame, band: Band = Band(), id_column: str = "doc_id",
           text_column: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text (whose end is the start
    of the next document), and their likeness to each other and to the next."""
    first = {"bigint": -(1 << 63), "int": -(1 << 31)}.get(
        docs.schema[id_column].dataType.simpleString(), "")
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(first)).alias("id"),
        F.xxhash64("text").alias("hash"), "text")
    terms = cut_lineage(lexicon(docs, band, text_column), "lexicon")
    ranges = _ranges(rows, range_bytes)
    made = followed(with_prints(rows, {"text": "parts"}, terms), ranges, ["text", "parts"])
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = made.select(
        "doc_id", chars.cast("long").alias("n_chars"), "parts", "next_parts",
        F.concat(F.substring("text", F.lit(1), chars - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited_text"))
    both = with_prints(edited, {"edited_text": "edited_parts"}, terms)
    return both.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint(F.col("parts")).alias("fingerprint"),
        fingerprint(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"))
