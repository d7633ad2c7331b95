"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions.

A window is ``WINDOW`` consecutive words of an item, or the whole item if it has
fewer.  It is taken as the set of its shingles of ``SHINGLE`` words.  As a
document must hold all of them, a single shingle is a sufficient prefix: shingles
are ordered by rarity over all documents, and each window joins on its rarest one
only.  The place of that shingle in the window bounds where the window can start
and end in the document (position and length), and then its words are compared
with the document's as they stand.

The windows are distinct and broadcast, at most ``BLOCK_WINDOWS`` at a time;
larger benchmarks are worked off in blocks.  Texts are cut into words, probed and
compared in the task that reads them, so only hits and one narrow row a document
are shuffled.  Documents that hold the same windows share one list of items.

Words are runs of characters other than ASCII signs, controls and white space,
after A to Z are lower-cased.

Defined cases: a null or empty text has no words and is clean; items without
words have no windows; items are told apart by id, so repeated ids are one item;
windows of an item without id mark words but are not listed; document rows stand
for themselves, also if ids repeat or are null; overlapping windows count a word
once; empty tables give an empty result, an empty benchmark clean documents;
other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WINDOW, SHINGLE = 10, 3
#: Distinct windows that are broadcast at a time, of about 200 bytes each.
BLOCK_WINDOWS = 200_000
#: Distinct lists of items up to which they are broadcast.
BROADCAST_LISTS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SIGNS = "".join(chr(c) for c in range(128) if not (chr(c).isdigit() or chr(c).islower()))


def padded_words(text: Column) -> Column:
    """The words of a text and an empty one behind them; two empty ones if it has none."""
    text = F.coalesce(text, F.lit(""))
    # Full lower-casing equals that of A to Z where all characters are ASCII, and is faster.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.split(F.concat(F.ltrim(lower, F.lit(_SIGNS)), F.lit(" ")), BETWEEN)


def windows_of(items: DataFrame, item_column: str, text_column: str,
               width: int) -> tuple[DataFrame, DataFrame]:
    """Stored (window, words) of the distinct windows, and (window, item_id)."""
    words = F.filter(padded_words(F.col(text_column)), lambda w: w != "")
    cut = (items.select(F.col(item_column).alias("item_id"), words.alias("all_words"))
           .where(F.size("all_words") > 0)
           .select("item_id", "all_words", F.explode(F.sequence(
               F.lit(1), F.greatest(F.size("all_words") - width + 1, F.lit(1)))).alias("first"))
           .select("item_id", F.slice("all_words", F.col("first"), width).alias("words")))
    windows = cut_lineage(cut.select("words").distinct().withColumn(
        "window", F.monotonically_increasing_id()), "item-windows")
    held = cut_lineage(cut.where("item_id IS NOT NULL").join(windows, "words")
                       .select("window", "item_id").distinct(), "window-items")
    return windows, held


def _key(words: Column, at: Column, shingle: int) -> Column:
    """Hash of the shingle that starts at place ``at``."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(shingle)])


def _probed(docs: DataFrame, widths: list[int]) -> DataFrame:
    """One row for every word of every document, with the shingle that starts
    there, and one more behind the last word."""
    # The list of words is passed along by reference: explode and the join behind
    # it are one generated loop, and only hits are written out.
    placed = docs.select("doc_row", "doc_id", "words", F.posexplode("words").alias("at", "_word"))
    keys = [_key(F.col("words"), F.col("at"), width) for width in widths]
    if len(keys) == 1:
        return placed.withColumn("key", keys[0])
    return placed.select("doc_row", "doc_id", "words", "at", F.explode(F.array(*keys)).alias("key"))


def _rarest(docs: DataFrame, windows: DataFrame, widths: list[int], blocks: int) -> DataFrame:
    """(window, words, key, shift): each window with its rarest shingle and the
    place of that in the window."""
    size = F.size("words")
    shingles = cut_lineage(windows.select("window", "words", F.explode(F.transform(
        F.sequence(F.lit(0), size - F.least(size, F.lit(SHINGLE))),
        lambda at: F.struct(at.alias("shift"), F.when(size >= SHINGLE, _key(F.col("words"), at, SHINGLE))
                            .when(size == 2, _key(F.col("words"), at, 2))
                            .otherwise(_key(F.col("words"), at, 1)).alias("key")))).alias("s"))
        .select("window", "words", "s.shift", "s.key"), "window-shingles")
    keys = shingles.select("key").distinct()
    probed = _probed(docs, widths).select("key")
    counts = [probed.join(F.broadcast(keys.where(F.pmod("key", F.lit(blocks)) == b)), "key")
              .groupBy("key").agg(F.count("*").alias("frequency")) for b in range(blocks)]
    counted = reduce(DataFrame.unionByName, counts)
    first = F.min(F.struct(F.coalesce("frequency", F.lit(0)), "shift", "key"))
    return (shingles.join(counted, "key", "left").groupBy("window")
            .agg(first.alias("f"), F.first("words").alias("words"))
            .select("window", "words", "f.shift", "f.key"))


def _found(docs: DataFrame, prefixes: DataFrame, widths: list[int], blocks: int) -> DataFrame:
    """A row for every window that stands in a document (start, n, window), and
    one row without window for every document."""
    out = None
    for block in range(blocks):
        own = F.broadcast(prefixes.where(F.pmod("window", F.lit(blocks)) == block).select(
            "key", "shift", "window", F.col("words").alias("wanted")))
        start, n = F.col("at") - F.col("shift"), F.size("wanted")
        inside = (start >= 0) & (start + n < F.size("words"))
        same = F.slice("words", F.greatest(start, F.lit(0)) + 1, n) == F.col("wanted")
        behind = F.col("at") == F.size("words") - 1
        rows = (_probed(docs, widths).alias("d").join(
            own.alias("w"), (F.col("d.key") == F.col("w.key")) & inside & same, "left")
            .where(F.col("window").isNotNull() | behind if block == 0
                   else F.col("window").isNotNull())
            .select("doc_row", "doc_id", F.when(F.get("words", F.lit(0)) == "", 0)
                    .otherwise(F.size("words") - 1).cast("long").alias("n_words"),
                    F.when(F.col("window").isNotNull(), start).alias("start"),
                    n.alias("n"), "window"))
        out = rows if out is None else out.unionByName(rows)
    return out


def hits(docs: DataFrame, items: DataFrame, width: int = WINDOW, id_column: str = "doc_id",
         text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as sorted strings) and contaminated."""
    windows, held = windows_of(items, item_column, item_text, width)
    blocks = max(1, math.ceil(windows.count() / block_windows))
    sizes = [r.n for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("n"))
             .distinct().collect()]
    widths = sorted(sizes) or [SHINGLE]
    numbered = docs.select(F.monotonically_increasing_id().alias("doc_row"),
                           F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    if blocks > 1:  # all blocks must agree on the rows
        numbered = cut_lineage(numbered, "numbered-texts")
    texts = numbered.select("doc_row", "doc_id", padded_words(F.col("text")).alias("words"))
    prefixes = cut_lineage(_rarest(texts, windows, widths, blocks), "window-prefixes")
    before = F.max(F.col("start") + F.col("n")).over(
        Window.partitionBy("doc_row").orderBy("start", "n")
        .rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("start") + F.col("n") - F.greatest("start", F.coalesce(before, F.col("start")))
    per_document = cut_lineage(
        _found(texts, prefixes, widths, blocks).withColumn("new", F.greatest(new, F.lit(0)))
        .groupBy("doc_row").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set("window")).alias("windows"))
        .withColumn("held", F.when(F.col("n_hit") > 0, F.sha2(F.array_join("windows", ","), 256))),
        "document-hits")
    dirty = per_document.where("held IS NOT NULL")
    lists = cut_lineage(
        dirty.groupBy("held").agg(F.first("windows").alias("windows"))
        .select("held", F.explode("windows").alias("window"))
        .join(held, "window", "left").groupBy("held")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")),
        "item-lists")
    few = lists.count() <= BROADCAST_LISTS
    listed = dirty.join(F.broadcast(lists) if few else lists, "held")
    clean = per_document.where("held IS NULL").withColumn("items", F.array().cast("array<string>"))
    names = ["doc_id", "n_words", "n_hit", "items"]
    return listed.select(names).unionByName(clean.select(names)).withColumn(
        "contaminated", F.col("n_hit") > 0)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document the counts, and a digest of its items."""
    return hits(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS doc_row, doc_id, list_filter(string_split_regex(
       translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '') AS words
     FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(
       translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '') AS words
     FROM benchmark),
s AS (SELECT item_id, words, least(len(words), {WINDOW}) AS k FROM b WHERE len(words) > 0),
i AS (SELECT item_id, k, unnest(list_transform(range(len(words) - k + 1),
             lambda x: array_to_string(words[x + 1 : x + k], ' '))) AS wanted FROM s),
w AS (SELECT DISTINCT item_id, k, wanted FROM i),
ks AS (SELECT DISTINCT k FROM w),
p AS (SELECT doc_row, k, words, unnest(range(len(words) - k + 1)) AS start
      FROM d, ks WHERE len(words) >= k),
m AS (SELECT doc_row, start, p.k AS k, item_id FROM p JOIN w
      ON p.k = w.k AND array_to_string(words[start + 1 : start + p.k], ' ') = wanted),
h AS (SELECT doc_row, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_row, unnest(range(start, start + k)) AS place FROM m) GROUP BY doc_row),
n AS (SELECT doc_row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_row, CAST(item_id AS VARCHAR) AS item FROM m
            WHERE item_id IS NOT NULL) GROUP BY doc_row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_row) LEFT JOIN n USING (doc_row)
"""
