"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has a bit set if it is set in over half of the hashes of the
document's word shingles.  Fingerprints link at ``max_bits`` = 2 or fewer
differing bits.  To find them, the 64 bits are cut into segments of 23, 23 and
18 bits.  Of two differing bits, some segment has none, and either way round
some segment without an error is followed by one with at most one.  So a key
is an exact segment with a Golay codeword for the next segment: the perfect
[23, 12] code maps every word to one codeword within three bits, and the
codewords of all words within one bit of a segment (one or six of them) include
the codeword of every segment within one bit.  Equal fingerprints are one node,
so copies are never paired.

Keys that many fingerprints share are not compared pair by pair: each of those
fingerprints names the 65 values within one bit of it, and two that name the
same value are linked.  No value is named by more than 65, and any two within
two bits share one, so this way is exact as well.

Defined cases: a null text is empty; a text of fewer words than a shingle is
one shingle, one without words has fingerprint zero and is linked like any
other; documents without an id belong to groups but are never their smallest
id; when duplicates are removed, texts decide and not ids: unlike texts of one
id stay, of a group without any id the row with the smallest digest stays;
repeated rows and ties change nothing; an empty table gives an empty result;
other columns are kept by ``deduplicated`` and not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import in_slices, release_memory, text_of
from .graph import components

MAX_BITS = 2
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit and length
#: A key held by more fingerprints than this is resolved by neighbouring values.
WIDE_KEY = 64
#: Fingerprints of one in so many of all rows, or more, are named by a broadcast.
COMMON = 1000
#: Generator of the [23, 12, 7] Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


@dataclass(frozen=True)
class Shingles:
    """Words per shingle; the defaults of a general near-duplicate search."""

    words: int = 5
    seed: int = 42


def _shingle_hashes(text: str, shingles: Shingles) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a text, A-Z lower-cased, in pieces."""
    words = text.encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    width = min(shingles.words, len(words))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    n = len(words) - width + 1
    digest, seed = xxhash.xxh64_intdigest, shingles.seed
    for first in range(0, n, 1 << 14):
        last = min(n, first + (1 << 14))
        yield np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(
                starts[first:last].tolist(), (starts[first + width:last + width] - 1).tolist())),
            np.uint64, last - first)


def _bit_counts(words: np.ndarray) -> np.ndarray:
    """How often each bit is set in rows of 64-bit words."""
    bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return sum((bits[a:a + 255].sum(axis=0, dtype=np.uint8).astype(np.int64)
                for a in range(0, len(bits), 255)), np.zeros(bits.shape[1], np.int64))


def fingerprint(text: str, shingles: Shingles) -> int:
    """The 64-bit fingerprint of one text."""
    return _majority(_shingle_hashes(text, shingles))


def _majority(pieces: Iterable[np.ndarray]) -> int:
    """The bits set in over half of the hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in pieces:
        counts += _bit_counts(hashes.reshape(-1, 1))
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingles: Shingles = Shingles(), id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """doc_id and fingerprint (a long that holds the 64 bits) of every document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py() or "", shingles)
                                  for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fingerprint"])

    return (docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, fingerprint long"))


# --- Golay keys --------------------------------------------------------------

def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@functools.lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits of a word, and the error of
    at most three bits that belongs to each remainder."""
    low = np.array([_remainder(x) for x in range(1 << 12)], np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], np.int64)
    bits = np.array([_remainder(1 << i) for i in range(23)])
    errors = np.full(1 << 11, -1, np.int64)
    errors[0] = 0
    for i in range(23):
        errors[bits[i]] = 1 << i
        for j in range(i):
            errors[bits[i] ^ bits[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[bits[i] ^ bits[j] ^ bits[k]] = 1 << i | 1 << j | 1 << k
    return low, high, errors


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within three bits of each 23-bit word."""
    low, high, errors = golay()
    remainder = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[remainder]) >> 11


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, home) of fingerprints: home is the segment's own codeword."""
    rows, keys, home = [], [], []
    at = np.arange(len(values))
    segments = [(values >> np.uint64(first) & np.uint64((1 << n) - 1)).astype(np.int64)
                for first, n in SEGMENTS]
    for s, (exact, fuzzy) in enumerate(zip(segments, segments[1:] + segments[:1])):
        own = codeword_indices(fuzzy)
        near = np.stack([own] + [codeword_indices(fuzzy ^ (1 << i)) for i in range(23)], axis=1)
        near.sort(axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(first)
        rows.append(at[r])
        keys.append(np.int64(s) << 35 | exact[r] << 12 | near[r, c])
        home.append(near[r, c] == own[r])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


def keyed(values: DataFrame) -> DataFrame:
    """(fingerprint, key, home) rows of distinct fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1 << 15):
                own = batch.column(0).slice(first, 1 << 15).to_numpy(zero_copy_only=False)
                rows, keys, home = golay_keys(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[rows]), pa.array(keys), pa.array(home)],
                    ["fingerprint", "key", "home"])

    return values.select("fingerprint").mapInArrow(
        run, "fingerprint long, key long, home boolean")


def links(values: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough of them that two
    fingerprints hang together if a chain of small differences joins them."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find up to {MAX_BITS} differing bits")
    held = cut_lineage(keyed(values), "simhash-keys")
    # Counted before they meet again, so a key that all hold is one row a task.
    counts = held.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = cut_lineage(held.join(counts, "key"), "simhash-shared")
    narrow = shared.where(F.col("holders") <= WIDE_KEY)
    homes = narrow.where("home").select("key", F.col("fingerprint").alias("a"))
    pairs = (homes.join(narrow.select("key", F.col("fingerprint").alias("b")), "key")
             .where("a <> b").where(_apart("a", "b") <= max_bits).select("a", "b"))
    wide = shared.where(F.col("holders") > WIDE_KEY).select("fingerprint").distinct()
    near = [F.col("fingerprint")] + [
        F.col("fingerprint").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long"))
        for i in range(64)]
    # At most 65 fingerprints are within one bit of a value, all within two of each other.
    balls = (wide.select("fingerprint", F.explode(F.array(*near)).alias("value"))
             .groupBy("value").agg(F.collect_list("fingerprint").alias("all"))
             .where(F.size("all") > 1))
    if max_bits == MAX_BITS:
        stars = balls.select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    else:
        stars = (balls.select("all", F.explode("all").alias("a"))
                 .select("a", F.explode("all").alias("b")).where(_apart("a", "b") <= max_bits))
    return pairs.unionByName(stars.where("a <> b"))


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def grouped(docs: DataFrame, shingles: Shingles = Shingles(), id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable)."""
    marked = cut_lineage(fingerprints(docs, shingles, id_column, text_column), "fingerprints")
    nodes = cut_lineage(marked.groupBy("fingerprint").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "simhash-nodes")
    found = components(links(nodes), "simhash")
    labelled = (nodes.join(found, nodes["fingerprint"] == found["node"], "left")
                .select("fingerprint", "first_id", "copies",
                        F.coalesce("component", "fingerprint").alias("component")))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = cut_lineage(labelled.join(least, "component").select(
        F.col("fingerprint").alias("print"), "copies", "component_id"), "simhash-named")
    return _named_copies(marked, named, F.col("fingerprint") == F.col("print")).select(
        "doc_id", "fingerprint", "component_id")


def _named_copies(marked: DataFrame, named: DataFrame, own: Column) -> DataFrame:
    """Each row of ``marked`` with its print's row of ``named`` (print, copies and more).

    A print of at least one in ``COMMON`` of all rows would put them into one
    task.  There are at most ``COMMON`` of these; they are broadcast, and their
    rows are not shuffled.
    """
    rows = named.agg(F.sum("copies")).first()[0] or 0
    common = F.col("copies") * COMMON >= rows
    often = named.where(common)
    return (marked.join(F.broadcast(often), own)
            .unionByName(marked.join(F.broadcast(often.select("print")), own, "left_anti")
                         .join(named.where(~common), own)))


# --- near copies ------------------------------------------------------------

#: Words of a wide fingerprint, and the min-hashes of a key and keys of a
#: document: texts of similarity 0.8 share none of them once in 500,000 pairs.
WIDE_WORDS, ROWS, BANDS = 8, 8, 72
SIMILARITY = 0.8
#: Bits of the filter that tells which texts are read again.
FILTER_BITS = 1 << 24
#: Sets and shingles of a group that are compared in one piece, and the sets of a
#: larger group that all its pieces are compared with first.
BLOCK, BLOCK_SHINGLES, PIVOTS = 512, 1 << 20, 8


def shingle_set(text: str, shingles: Shingles) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return _distinct(_shingle_hashes(text, shingles))


def _distinct(pieces: Iterable[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *pieces]))


def set_node(hashes: np.ndarray) -> int:
    """The number of a shingle set, as a signed long."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """A fingerprint of 512 bits of a shingle set: each hash is mixed into eight words."""
    steps = np.arange(1, WIDE_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(64 * WIDE_WORDS, np.int64)
    for first in range(0, len(hashes), 1 << 13):
        x = hashes[first:first + (1 << 13), None] + steps
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        counts += _bit_counts(x ^ (x >> np.uint64(31)))
    return np.packbits(2 * counts > len(hashes), bitorder="little").tobytes()


def differing_bits(similarity: float) -> int:
    """Bits of 512 in which texts differ whose shingle sets have this Jaccard similarity."""
    return int(64 * WIDE_WORDS * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def loose_bits(similarity: float) -> int:
    """A bound on these bits: six standard deviations more than the average."""
    mean = differing_bits(similarity)
    return int(mean + 6 * np.sqrt(mean * (1 - mean / (64 * WIDE_WORDS))))


@functools.lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of a shingle set: digests of ``ROWS`` min-hashes each."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(hashes), 1 << 9):
        np.minimum(least, (hashes[first:first + (1 << 9), None] * _multipliers()).min(axis=0), out=least)
    return np.array([xxhash.xxh3_64_intdigest(band.tobytes(), k) - (1 << 63)
                     for k, band in enumerate(least.reshape(BANDS, ROWS))], np.int64)


def near_forest(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the fingerprints (rows of 64-bit words) a member of its
    component.  They are compared with all, one after another, those that are
    not near the first one before the others, until all hang together: a tight
    group takes one comparison a member."""
    n = len(prints)
    label = np.arange(n)

    def meet(i: int) -> np.ndarray:
        near = np.bitwise_count(prints ^ prints[i]).sum(axis=1, dtype=np.int64) <= max_bits
        met = np.unique(label[near])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
        return near

    near_first = meet(0)
    for i in [*np.nonzero(~near_first)[0], *np.nonzero(near_first)[0][1:]]:
        if (label == label[0]).all():
            break
        meet(i)
    return label


def set_forest(sets: list[np.ndarray], prints: np.ndarray, label: np.ndarray,
               similarity: float) -> np.ndarray:
    """For each shingle set a member of its component.  ``label`` has what is
    known to hang together; only sets with different labels are compared, with
    their fingerprints and, where these are not far apart, exactly."""
    label = np.unique(label, return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets])
    max_bits = loose_bits(similarity)
    for i in range(len(sets)):
        other = np.nonzero(label != label[i])[0]
        if not len(other):
            continue
        # A ratio of sizes below the similarity leaves no room for it.
        fits = np.minimum(sizes[other], sizes[i]) >= similarity * np.maximum(sizes[other], sizes[i]) - 1e-9
        other = other[fits]
        other = other[np.bitwise_count(prints[other] ^ prints[i]).sum(axis=1, dtype=np.int64) <= max_bits]
        met = {int(label[i])}
        for j in other.tolist():
            if int(label[j]) not in met:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                    met.add(int(label[j]))
        if len(met) > 1:
            label[np.isin(label, list(met))] = min(met)
    first = np.full(len(sets), len(sets))
    np.minimum.at(first, label, np.arange(len(sets)))
    return first[label]


def _linked_sets(cells: DataFrame, similarity: float) -> DataFrame:
    """(a, b) links of the rows (cell, node, label, hashes, print) of a cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one cell, which follow each other."""
        held: list[pa.RecordBatch] = []

        def runs(rows: pa.Table) -> pa.RecordBatch:
            cell, node, label = (rows.column(c).to_numpy() for c in ("cell", "node", "label"))
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
            prints = np.frombuffer(b"".join(rows.column("print").to_pylist()),
                                   np.uint64).reshape(len(cell), -1)
            cuts = [0, *(np.nonzero(cell[1:] != cell[:-1])[0] + 1).tolist(), len(cell)]
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start, stop in zip(cuts, cuts[1:]):
                if stop - start > 1:
                    root = set_forest(sets[start:stop], prints[start:stop], label[start:stop], similarity)
                    a.append(node[start:stop])
                    b.append(node[start:stop][root])
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy()
            last = int(np.searchsorted(cell, cell[-1]))  # cells are sorted
            if last:
                yield runs(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield runs(pa.Table.from_batches(held))
        held = []
        release_memory()

    return (cells.select("cell", "node", "label", "hashes", "print").repartition("cell")
            .sortWithinPartitions("cell", "node").mapInArrow(run, "a long, b long"))


def _pieces(rows: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def near_links(sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join all similar sets of a candidate group; ``sets`` has
    group, node, hashes and print.

    A crowded group is cut into blocks, each of which also gets the group's
    pivots, so that a tight group hangs together at once.  Then the sets outside
    the group's largest component meet each other and that component, block by block.
    """
    narrow = cut_lineage(sets.select("group", "node", (F.length("hashes") / 8).alias("size")),
                         "near-sizes")
    per = cut_lineage(narrow.groupBy("group").agg(
        _pieces(F.count("*"), F.sum("size")).alias("blocks")), "near-blocks")
    placed = narrow.join(per, "group").withColumn(
        "own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    first = Window.partitionBy("group").orderBy(F.xxhash64("node", F.lit(2)), "node")
    pivots = (narrow.join(per.where("blocks > 1"), "group")
              .withColumn("place", F.row_number().over(first)).where(F.col("place") <= PIVOTS)
              .withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cells = (placed.select("group", "node", "own").unionByName(pivots.select("group", "node", "own"))
             .distinct().select(F.xxhash64("group", "own").alias("cell"), "node",
                                F.col("node").alias("label")))
    contents = sets.select("node", "hashes", "print")
    links = cut_lineage(_linked_sets(cells.join(contents, "node"), similarity), "near-links")
    crowded = per.where("blocks > 1").select("group")
    if crowded.isEmpty():
        return links
    known = components(links, "near-blocks").withColumnRenamed("node", "known_node")
    labelled = cut_lineage(
        narrow.join(crowded, "group").join(known, F.col("node") == F.col("known_node"), "left")
        .select("group", "node", "size", F.coalesce("component", "node").alias("label")),
        "near-labels")
    counts = labelled.groupBy("group", "label").agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
    largest = counts.groupBy("group").agg(
        F.max(F.struct("rows", "label", "size")).alias("main"),
        F.sum("rows").alias("rows"), F.sum("size").alias("size"))
    main = cut_lineage(largest.where(F.col("rows") > F.col("main.rows")).select(
        "group", F.col("main.label").alias("main"),
        _pieces(F.col("main.rows"), F.col("main.size")).alias("inner"),
        _pieces(F.col("rows") - F.col("main.rows"), F.col("size") - F.col("main.size")).alias("outer")),
        "near-outer")
    if main.isEmpty():
        return links
    rows = (labelled.join(main, "group").withColumn("inside", F.col("label") == F.col("main"))
            .withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.when(
                F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int")))
    outer = F.explode(F.sequence(F.lit(0), F.col("outer") - 1))
    inner = F.explode(F.sequence(F.lit(0), F.col("inner") - 1))
    across = rows.where("inside").withColumn("low", outer).withColumn("high", F.col("own")).unionByName(
        rows.where("not inside").withColumn("low", F.col("own")).withColumn("high", inner))
    among = (rows.where("not inside").withColumn("other", outer)
             .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")))
    cells = (across.withColumn("kind", F.lit(1)).unionByName(
        among.drop("other").withColumn("kind", F.lit(2)))
        .select(F.xxhash64("group", "kind", "low", "high").alias("cell"), "node", "label"))
    return links.unionByName(_linked_sets(cells.join(contents, "node"), similarity))


def print_links(marked: DataFrame) -> DataFrame:
    """Links (a, b) of the nodes of ``marked`` (node, fingerprint) whose fingerprints
    are within ``MAX_BITS`` of each other, found by Golay keys, or hang together over others."""
    held = marked.select("node", "fingerprint").distinct()
    prints = cut_lineage(held.groupBy("fingerprint").agg(
        F.min("node").alias("first_node"), F.max("node").alias("last_node")), "near-prints")
    shared = prints.where("first_node < last_node").select(
        F.col("fingerprint").alias("print"), F.col("first_node").alias("b"))
    equal = (held.join(shared, F.col("fingerprint") == F.col("print"))
             .where("node <> b").select(F.col("node").alias("a"), "b"))
    ends = links(prints)
    for end in ("a", "b"):
        named = prints.select(F.col("fingerprint").alias(end), F.col("first_node").alias("_node"))
        ends = ends.join(named, end).drop(end).withColumnRenamed("_node", end)
    return cut_lineage(equal.unionByName(ends), "near-print-links")


def near_grouped(docs: DataFrame, shingles: Shingles = Shingles(), similarity: float = SIMILARITY,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, digest (of the text), component_id (the smallest doc_id of its group
    of near copies) and keeper: whether the group's first row has this id and text.

    Documents link if their fingerprints differ in at most ``MAX_BITS`` bits, found
    by Golay keys as in :func:`grouped`.  Beside them, as that distance leaves out
    many near copies, documents link if the Jaccard similarity of their sets of
    shingles is at least ``similarity``.  Sets that share a key of min-hashes, directly or over
    others, are a candidate group.  The texts of these groups are read again and
    compared exactly where their 512-bit fingerprints are not far apart.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
                        F.md5(text_of(text_column)).alias("digest"))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            node, prints, keys = [], [], []
            for t in batch.column(1):
                pieces = list(_shingle_hashes(t.as_py() or "", shingles))
                hashes = _distinct(pieces)
                node.append(set_node(hashes))
                prints.append(_majority(pieces))
                keys.append(band_keys(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(node, pa.int64()),
                 pa.array(np.array(prints, np.uint64).view(np.int64)),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "node", "fingerprint", "keys"])

    marked = cut_lineage(texts.mapInArrow(
        marks, f"doc_id {kind}, digest string, node long, fingerprint long, keys array<long>"),
        "near-marks")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    nodes = cut_lineage(marked.groupBy("node").agg(
        F.min(own).alias("first"), F.count("*").alias("copies")), "near-nodes")
    keyed_nodes = marked.select("node", F.explode("keys").alias("key")).distinct()
    shared = (keyed_nodes.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .where("least < most").select(F.col("key").alias("shared_key"), "least"))
    stars = (keyed_nodes.join(shared, F.col("key") == F.col("shared_key"))
             .select(F.col("node").alias("a"), F.col("least").alias("b")))
    groups = cut_lineage(components(stars, "near-candidates").select(
        F.col("node").alias("group_node"), F.col("component").alias("group")), "near-groups")
    # One bit for each candidate, in at most FILTER_BITS / 32 rows: bounded by construction.
    place = F.pmod(F.col("group_node"), F.lit(FILTER_BITS))
    rows = (groups.groupBy(F.floor(place / 32).cast("int").alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(group_node, {FILTER_BITS}) % 32 as int))"))
                 .alias("bits")).toArrow())
    wanted = np.zeros(FILTER_BITS // 32, np.uint32)
    wanted[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    passing = docs.sparkSession.sparkContext.broadcast(wanted)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = passing.value
        for batch in in_slices(batches):
            node, kept, prints = [], [], []
            for t in batch.column(0):
                hashes = shingle_set(t.as_py() or "", shingles)
                own = set_node(hashes)
                at = own % FILTER_BITS
                if words[at >> 5] >> np.uint32(at & 31) & np.uint32(1):
                    node.append(own)
                    kept.append(hashes.tobytes())
                    prints.append(wide_fingerprint(hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.binary()),
                 pa.array(prints, pa.binary())], ["node", "hashes", "print"])

    sets = cut_lineage(
        texts.select("text").mapInArrow(again, "node long, hashes binary, print binary")
        .groupBy("node").agg(F.first("hashes").alias("hashes"), F.first("print").alias("print"))
        .join(groups, F.col("node") == F.col("group_node"))
        .select("group", "node", "hashes", "print"), "near-sets")
    near = near_links(sets, similarity).unionByName(print_links(marked))
    found = components(near, "near-copies").withColumnRenamed("node", "found_node")
    labelled = (nodes.join(found, F.col("node") == F.col("found_node"), "left")
                .select("node", "first", "copies", F.coalesce("component", "node").alias("component")))
    least = labelled.groupBy("component").agg(F.min("first").alias("keeper"))
    named = cut_lineage(labelled.join(least, "component").select(
        F.col("node").alias("print"), "copies", "keeper"), "near-named")
    return _named_copies(marked.select("doc_id", "digest", "node"), named,
                         F.col("node") == F.col("print")).select(
        "doc_id", "digest", F.col("keeper.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))
         & (F.col("digest") == F.col("keeper.digest"))).alias("keeper"))


def deduplicated(docs: DataFrame, shingles: Shingles = Shingles(),
                 similarity: float = SIMILARITY, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """The documents, with all their columns, one of each group of near copies:
    that with the smallest id (rows without an id come last), then the smallest
    text digest.  Unlike texts of one id are not copies of each other, and all stay."""
    groups = cut_lineage(near_grouped(docs, shingles, similarity, id_column, text_column),
                         "simhash-groups")
    # A digest has 32 characters, so ids of any kind follow it unmistakably.
    def key(digest: Column, doc_id: Column) -> Column:
        return F.concat(digest, F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("")))

    notes = cut_lineage(
        groups.groupBy(key(F.col("digest"), F.col("doc_id")).alias("noted_key"))
        .agg(F.count("*").alias("times"), F.first("keeper").alias("stays"))
        .where("times > 1 or not stays"), "near-notes")
    text = F.coalesce(F.col("row")[text_column], F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "_key", key(F.md5(text), F.col("row")[id_column]))
    own = F.col("_key") == F.col("noted_key")
    # Rows that agree in id and text may differ in other columns.
    place = F.xxhash64(F.to_json("row"))
    often = notes.where(F.col("times") * COMMON >= groups.count()).where("times > 1")
    repeats = not often.isEmpty()
    rest = packed
    if repeats:  # at most ``COMMON`` keys, whose rows would crowd one task
        rest = packed.join(F.broadcast(often.select("noted_key")), own, "left_anti")
    # The notes grow with the documents, so both sides are shuffled at every
    # size: texts move once, and rows with the same id and text are then together.
    noted = rest.join(notes.hint("merge"), own, "left")
    order = Window.partitionBy("_key").orderBy(F.when(F.col("times") > 1, place))
    kept = (noted.withColumn("_place", F.row_number().over(order))
            .where("noted_key is null or (stays and _place = 1)").select("row.*"))
    if repeats:
        kept = kept.unionByName(
            packed.join(F.broadcast(often.where("stays").select("noted_key")), own, "left_semi")
            .groupBy("_key").agg(F.min_by("row", place).alias("row")).select("row.*"))
    return kept


def report(docs: DataFrame) -> DataFrame:
    """Three-word shingles, fingerprints as 16 hexadecimal digits."""
    return grouped(docs, Shingles(words=3)).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
