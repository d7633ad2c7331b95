"""Ranked lexical search: an Aho-Corasick scan of all texts, without an index.

The distinct terms of the items, each guarded by a blank on both sides, form
one automaton that every task builds from a broadcast list.  It reads each text
once and counts term frequencies as it goes; its outputs map to the items that
hold the term, so one pass over a text scores it for all items.  A first scan
counts documents, terms and document frequencies, a second one scores.  A task
hands on its ``top`` best documents per item only.

What is broadcast is bounded: items are worked off in blocks of about
``BLOCK_TERMS`` pairs of item and term (or a single larger item), dealt by hash.

Terms are runs of characters other than ASCII signs, controls and white space,
A to Z lower-cased; bytes of other characters never equal ASCII ones, so texts
are cut as UTF-8.

Defined cases: a null or empty text has no terms and is in no count; items
without terms return nothing; each item row is ranked on its own, also if ids
repeat or are null; each document row counts, repeated rows rank beside each
other; equal scores go by ascending doc_id, a null id last; a very long text is
fed to the automaton in slices; empty tables give an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage

TOP = 20
#: Pairs of item and distinct term in one automaton.
BLOCK_TERMS = 200_000
#: Bytes of text that are handed to the automaton at a time.
SLICE = 1 << 20
#: Products of a term and an item that are added up in one step.
STEP = 1 << 20
#: Groups of tasks whose best documents are ranked apart before all meet.
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Each byte as a term's letter, or as a blank.
_LETTERS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32
                 for b in range(256))


def terms_of(text: Column) -> Column:
    """The terms of a text, repeats included."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)
    return F.filter(parts, lambda term: term != "")


def weight(documents: int, frequency: int) -> int:
    """Weight of a term that ``frequency`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


@dataclass
class Items:
    """The items of one block: terms, and for each term the items that hold it."""

    ids: list
    rows: list[int]
    terms: list[str]
    starts: np.ndarray   # of the term's items in the next two
    holders: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, pairs: list) -> Items:
        """From rows (item_row, item_id, term, times)."""
        ids = dict(sorted({r.item_row: r.item_id for r in pairs}.items()))
        terms = sorted({r.term for r in pairs})
        item_at = {row: i for i, row in enumerate(ids)}
        term_at = {term: i for i, term in enumerate(terms)}
        table = np.array(sorted((term_at[r.term], item_at[r.item_row], r.times) for r in pairs),
                         np.int64).reshape(-1, 3)
        return cls(list(ids.values()), list(ids), terms,
                   np.searchsorted(table[:, 0], np.arange(len(terms) + 1)),
                   table[:, 1].copy(), table[:, 2].copy())

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            out.add_word(" " + term.encode().decode("latin-1") + " ", i)
        out.make_automaton()
        return out


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    """Texts as bytes in which only letters of terms and blanks are left."""
    for text in batch.column("text").cast(pa.binary()):
        yield text.as_buffer().to_pybytes().translate(_LETTERS) if text.is_valid else b""


def _length(data: bytes) -> int:
    """Number of terms."""
    letter = np.frombuffer(data, np.uint8) != 32
    return int(letter[:1].sum()) + int((letter[1:] & ~letter[:-1]).sum())


def _hits(automaton: ahocorasick.Automaton, data: bytes) -> Iterator[int]:
    """Numbers of the terms in a text, one for each occurrence."""
    search = automaton.iter(" ")
    for _ in search:  # the blank before the first term
        pass
    for first in range(0, len(data), SLICE):
        search.set(data[first:first + SLICE].decode("latin-1"))  # goes on where it stood
        yield from map(itemgetter(1), search)
    search.set(" ")
    yield from map(itemgetter(1), search)


def _statistics(texts: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, document frequencies."""
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        documents, terms, held = 0, 0, Counter()
        for batch in batches:
            for data in _texts(batch):
                n = _length(data)
                documents, terms = documents + (n > 0), terms + n
                held.update(set(_hits(automaton, data)))
        held[-1], held[-2] = documents, terms
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int32()),
                                          pa.array(held.values(), pa.int64())], ["term", "n"])

    counted = (texts.select("text").mapInArrow(run, "term int, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).collect())
    found = {r.term: r.n for r in counted}
    return (found.get(-1, 0), found.get(-2, 0),
            np.array([found.get(i, 0) for i in range(len(items.terms))], np.int64))


@dataclass
class Best:
    """The best documents of each item so far."""

    top: int
    items: int

    def __post_init__(self) -> None:
        self.item = np.zeros(0, np.int64)
        self.score, self.doc = self.item.copy(), self.item.copy()
        self.no_id = np.zeros(0, bool)
        self.least = np.ones(self.items, np.int64)  # a score below this is not among them

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        good = score >= self.least[item]
        item, score = np.append(self.item, item[good]), np.append(self.score, score[good])
        doc, no_id = np.append(self.doc, doc[good]), np.append(self.no_id, no_id[good])
        order = np.lexsort((doc, no_id, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.top]
        self.least[item[place == self.top - 1]] = score[order[place == self.top - 1]]
        self.item, self.score = item[place < self.top], score[kept]
        self.doc, self.no_id = doc[kept], no_id[kept]


def _scored(texts: DataFrame, items: Items, documents: int, terms: int, weights: np.ndarray,
            top: int, item_kind: pa.DataType, schema: str) -> DataFrame:
    """The ``top`` best documents of each task for each item."""
    shared = texts.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        automaton = items.automaton()
        holders_n = np.diff(items.starts)
        best = Best(top, len(items.ids))

        def settle(found: list[tuple]) -> None:
            """Scores of some documents: (doc_id, m, term numbers, frequencies) each."""
            if not found:
                return
            sizes = np.array([len(x[2]) for x in found])
            at = np.repeat(np.arange(len(found)), sizes)
            term, tf = np.concatenate([x[2] for x in found]), np.concatenate([x[3] for x in found])
            m = np.array([x[1] for x in found], np.int64)[at]
            part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            n = holders_n[term]
            place = np.repeat(items.starts[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(at, n) * len(items.ids) + items.holders[place]
            score = np.zeros(len(found) * len(items.ids), np.int64)
            np.add.at(score, cell, np.repeat(part, n) * items.times[place])
            cell = np.nonzero(score)[0]
            doc = cell // len(items.ids)
            ids = [x[0] for x in found]
            best.add(cell % len(items.ids), score[cell],
                     np.array([0 if x is None else x for x in ids], np.int64)[doc],
                     np.array([x is None for x in ids])[doc])

        for batch in batches:
            held, work = [], 0
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                tf = Counter(_hits(automaton, data))
                if not tf:
                    continue
                numbers = np.fromiter(tf.keys(), np.int64, len(tf))
                m = 100 - 25 + 25 * _length(data) * documents // terms
                held.append((doc_id, m, numbers, np.fromiter(tf.values(), np.int64, len(tf))))
                work += len(items.ids) + int(holders_n[numbers].sum())
                if work >= STEP:
                    settle(held)
                    held, work = [], 0
            settle(held)
        yield pa.RecordBatch.from_arrays([
            pa.array([items.rows[i] for i in best.item], pa.int64()),
            pa.array([items.ids[i] for i in best.item], item_kind),
            pa.array(best.doc, pa.int64(), mask=best.no_id), pa.array(best.score, pa.int64())],
            ["item_row", "item_id", "doc_id", "score"])

    return texts.mapInArrow(run, schema)


def _first(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id",
           text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents of each item."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                        F.col(text_column).alias("text"))
    kind = items.schema[item_column].dataType
    schema = f"item_row long, item_id {kind.simpleString()}, doc_id long, score long"
    stated = cut_lineage(items.select(
        F.monotonically_increasing_id().alias("item_row"), F.col(item_column).alias("item_id"),
        terms_of(F.col(item_text)).alias("terms")).where(F.size("terms") > 0), "search-items")
    total = stated.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0
    blocks = math.ceil(total / block_terms)
    out = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        own = stated.where(F.pmod(F.xxhash64("item_row"), F.lit(blocks)) == block)
        pairs = (own.select("item_row", "item_id", F.explode("terms").alias("term"))
                 .groupBy("item_row", "item_id", "term").agg(F.count("*").alias("times"))).collect()
        if not pairs:
            continue
        held = Items.of(pairs)
        documents, terms, frequency = _statistics(texts, held)
        weights = np.array([weight(documents, int(n)) for n in frequency], np.int64)
        found = _scored(texts, held, documents, max(terms, 1), weights, top,
                        to_arrow_type(kind), schema)
        out = found if blocks == 1 else out.unionByName(found)
    # Tasks are ranked in groups first, so an item never meets the rows of all tasks at once.
    salted = out.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return (_first(_first(salted, top, "item_row", "item_id", "_group"), top, "item_row", "item_id")
            .select("item_id", "rank", "doc_id", "score"))


SQL = rf"""
WITH cut AS (SELECT row_number() OVER () AS doc_row, doc_id, list_filter(string_split_regex(
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '') AS terms
       FROM documents),
wanted AS (SELECT row_number() OVER () AS item_row, item_id, unnest(list_filter(string_split_regex(
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '')) AS term
       FROM benchmark),
asked AS (SELECT item_row, item_id, term, count(*) AS times FROM wanted GROUP BY ALL),
totals AS (SELECT count(*) AS all_n, CAST(sum(len(terms)) AS BIGINT) AS all_l FROM cut
           WHERE len(terms) > 0),
each AS (SELECT doc_row, doc_id, len(terms) AS n, unnest(terms) AS term FROM cut),
tf AS (SELECT doc_row, doc_id, n, term, count(*) AS tf FROM each GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(all_n) + 2) / (2 * count(*) + 1)))
                   AS BIGINT) AS w FROM tf, totals GROUP BY term),
parts AS (SELECT doc_row, doc_id, term, w * ((1000000000 * tf)
                 // (1000 * tf + 12 * (100 - 25 + ((25 * n * all_n) // all_l)))) AS part
          FROM tf JOIN weights USING (term), totals),
scores AS (SELECT item_row, item_id, doc_row, doc_id, CAST(sum(part * times) AS BIGINT) AS score
           FROM parts JOIN asked USING (term) GROUP BY ALL HAVING sum(part * times) > 0),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_row
                          ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {TOP}
"""
