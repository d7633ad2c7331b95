"""Hard negatives by spanning-tree bounds of anchors.

Anchors are worked off in groups of bounded size.  A group's anchors form a
minimum spanning tree by distance.  Every task holds one such tree and passes
its vectors through it from the root: the score of a vector with a child anchor
lies within edge length times the vector's length of its score with the parent,
so a bound is known before any product is formed.  Only vectors whose bound
overlaps what the anchor still looks for are scored again, exactly; the others
pass their wider bound on.

A first pass finds each anchor's positives, a second one fills the score window
of each positive.  A task hands on the first few vectors per anchor or window,
and tasks are ranked in groups before all of them meet.

Components are taken as floor(256 x); products are exact: in doubles where no
sum can reach 2^53, else in 64-bit integers.

Defined cases: rows with a null label, a null vector, a null or non-finite
component take no part, nor do vectors of length 2^31 and more after scaling,
of which products might not fit into 64 bits; vectors of different numbers of
components have no score with each other; every row counts, also if ids repeat
(an anchor row is no partner of itself, but of its copies); a null id is never
an anchor and comes last among equal scores; empty vectors score 0; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative scores from 80 to 100 hundredths of its positive.
LOW, HIGH = 80, 100
ANCHOR_EVERY, CLASSES, FLIPPED_EVERY = 100, 10, 7
#: Anchors of one group, and bytes of their vectors.
MAX_ANCHORS, MAX_ANCHOR_BYTES = 4096, 16 << 20
#: Bounds (anchors times vectors) that a task holds at a time.
CELLS = 1 << 22
SALTS = 32
_LIMIT = 2.0**31
_EXACT = 2.0**52


# --- vectors ----------------------------------------------------------------------

def scaled(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
           label_column: str = "label") -> DataFrame:
    """Stored (row, vec_id, label, width, units): usable rows with their scaled
    components, packed as doubles."""
    kind = vectors.schema[label_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, widths = [], []
            for x in batch.column("vector"):
                v = np.array(x.as_py(), float)
                v = np.floor(v * SCALE) if np.isfinite(v).all() else None
                good = v is not None and np.abs(v).max(initial=0) < _LIMIT and v @ v < _LIMIT**2
                units.append(v.tobytes() if good else None)
                widths.append(len(v) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(widths, pa.int32()),
                 pa.array(units, pa.binary())], ["row", "vec_id", "label", "width", "units"])

    whole = F.col(vector_column).isNotNull() & ~F.exists(vector_column, lambda x: x.isNull())
    return cut_lineage(
        vectors.where(F.col(label_column).isNotNull() & whole).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"),
            F.col(vector_column).cast("array<double>").alias("vector"))
        .mapInArrow(run, f"row long, vec_id long, label {kind}, width int, units binary")
        .where("units IS NOT NULL"), "scaled-vectors")


def products(many: np.ndarray, one: np.ndarray, longest: float, length: float) -> np.ndarray:
    """Inner products as exact integers."""
    if longest * length < _EXACT:
        return (many @ one).astype(np.int64)
    return many.astype(np.int64) @ one.astype(np.int64)


# --- the tree -----------------------------------------------------------------------

@dataclass
class Tree:
    """Anchors of one width, parents before children."""

    rows: np.ndarray      # of the table of vectors
    ids: np.ndarray
    labels: list
    units: np.ndarray
    parent: np.ndarray    # place in this order; -1 for the root
    edge: np.ndarray      # upper bound of the distance to the parent
    last_child: np.ndarray  # place of the last child, or of the anchor itself


def spanning_tree(rows: list) -> Tree:
    """The minimum spanning tree of (row, vec_id, label, units), depth first."""
    rows = sorted(rows, key=lambda r: r.row)
    units = np.frombuffer(b"".join(r.units for r in rows), np.float64).reshape(len(rows), -1)
    n = len(rows)
    nearest, parent = np.full(n, np.inf), np.full(n, -1)
    open_, now = np.ones(n, bool), 0
    children: list[list[int]] = [[] for _ in rows]
    for _ in range(n - 1):
        open_[now] = False
        apart = np.sqrt(((units - units[now]) ** 2).sum(axis=1))
        closer = open_ & (apart < nearest)
        nearest[closer], parent[closer] = apart[closer], now
        now = int(np.argmin(np.where(open_, nearest, np.inf)))
        children[parent[now]].append(now)
    order, stack = [], [0]
    while stack:
        order.append(stack.pop())
        stack += children[order[-1]]
    at = np.empty(n, int)
    at[order] = np.arange(n)
    up = np.array([at[parent[i]] if parent[i] >= 0 else -1 for i in order])
    last = np.arange(n)
    for place, above in enumerate(up.tolist()):
        if above >= 0:
            last[above] = place
    return Tree(np.array([rows[i].row for i in order]), np.array([rows[i].vec_id for i in order]),
                [rows[i].label for i in order], units[order], up,
                np.where(up >= 0, nearest[order] * (1 + 1e-9) + 1e-6, 0), last)


Wanted = Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Scored = Callable[[int, np.ndarray, np.ndarray], None]


def descend(tree: Tree, units: np.ndarray, labels: np.ndarray, wanted: Wanted, scored: Scored) -> int:
    """Pass vectors through the tree.  ``wanted`` says of an anchor, the vectors'
    bounds and whether labels are equal, which vectors to score; ``scored`` takes
    places and scores.  Returns how many products were formed."""
    lengths = np.sqrt((units * units).sum(axis=1)) * (1 + 1e-9)
    longest = float(lengths.max(initial=0))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    formed = 0
    for place, above in enumerate(tree.parent.tolist()):
        equal = labels == tree.labels[place]
        if above < 0:
            low, high = np.full(len(units), -np.inf), np.full(len(units), np.inf)
            again = np.arange(len(units))  # the root knows every score
            useful = wanted(place, low, high, equal)
        else:
            reach = tree.edge[place] * lengths
            low, high = bounds[above][0] - reach, bounds[above][1] + reach
            if tree.last_child[above] == place:
                del bounds[above]
            useful = wanted(place, low, high, equal)
            again = np.nonzero(useful)[0]
        exact = products(units if len(again) == len(units) else units[again], tree.units[place],
                         longest, float(np.sqrt(tree.units[place] @ tree.units[place])))
        formed += len(again)
        low[again] = high[again] = exact
        if tree.last_child[place] > place:
            bounds[place] = low, high
        good = useful[again]
        scored(place, again[good], exact[good])
    return formed


# --- what a task keeps ---------------------------------------------------------------

class First:
    """The first ``n`` vectors by score, id and row."""

    def __init__(self, n: int) -> None:
        self.n, self.score = n, np.zeros(0, np.int64)
        self.id, self.row, self.no_id = self.score, self.score, np.zeros(0, bool)

    @property
    def least(self) -> float:
        """Lower scores do not get in any more."""
        return float(self.score[-1]) if len(self.score) == self.n else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray, row: np.ndarray) -> None:
        score, ids = np.append(self.score, score), np.append(self.id, ids)
        no_id, row = np.append(self.no_id, no_id), np.append(self.row, row)
        order = np.lexsort((row, ids, no_id, -score))[:self.n]
        self.score, self.id, self.no_id, self.row = score[order], ids[order], no_id[order], row[order]


def _blocks(batches: Iterator[pa.RecordBatch], width: int, size: int) -> Iterator[tuple]:
    """(row, vec_id, null flags, labels, vectors) of at most ``size`` rows each."""
    for batch in batches:
        for first in range(0, batch.num_rows, size):
            part = batch.slice(first, size)
            ids = part.column("vec_id")
            raw = b"".join(x.as_buffer().to_pybytes() for x in part.column("units"))
            yield (part.column("row").to_numpy(), ids.fill_null(0).to_numpy(),
                   ids.is_null().to_numpy(zero_copy_only=False),
                   part.column("label").to_numpy(zero_copy_only=False),
                   np.frombuffer(raw, np.float64).reshape(part.num_rows, width))


_FOUND = "place int, target long, score long, vec_id long, row long"


def _found_batch(kept: dict[tuple[int, int], First]) -> pa.RecordBatch:
    def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, kind)

    sizes = [len(x.score) for x in kept.values()]
    lists = list(kept.values())
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat([k[0] for k in kept], sizes).astype(np.int32)),
        pa.array(np.repeat([k[1] for k in kept], sizes).astype(np.int64)),
        pa.array(joined([x.score for x in lists], np.int64)),
        pa.array(joined([x.id for x in lists], np.int64), mask=joined([x.no_id for x in lists], bool)),
        pa.array(joined([x.row for x in lists], np.int64))],
        ["place", "target", "score", "vec_id", "row"])


def _best(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each anchor and target over all tasks."""
    def first(rows: DataFrame, *keys: str) -> DataFrame:
        window = Window.partitionBy("place", "target", *keys).orderBy(
            F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)

    salted = found.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return first(first(salted, "_group"))


def positives(rows: DataFrame, tree: Tree, n: int) -> list:
    """(place, score, vec_id, row, rank) of each anchor's first ``n`` other rows
    of its label: at most ``n`` rows an anchor."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        kept = {(i, 0): First(n) for i in range(len(tree.rows))}
        for row, ids, no_id, labels, units in _blocks(batches, tree.units.shape[1],
                                                      max(256, CELLS // len(tree.rows))):
            def wanted(place: int, low: np.ndarray, high: np.ndarray, equal: np.ndarray) -> np.ndarray:
                return equal & (row != tree.rows[place]) & (high >= kept[place, 0].least)

            def scored(place: int, at: np.ndarray, score: np.ndarray) -> None:
                good = score >= kept[place, 0].least
                at = at[good]
                kept[place, 0].add(score[good], ids[at], no_id[at], row[at])

            descend(tree, units, labels, wanted, scored)
        yield _found_batch(kept)

    return _best(rows.mapInArrow(run, _FOUND), n).collect()


def negatives(rows: DataFrame, tree: Tree, targets: dict[int, list[int]], n: int,
              low_share: int, high_share: int) -> DataFrame:
    """place, target (a positive's score) and the first ``n`` rows of other labels
    in the window below it."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, targets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, targets = shared.value
        # Whole scores between low / 100 and high / 100 of the positive's.
        spans = {place: [(t, -(-low_share * t // 100), high_share * t // 100) for t in scores]
                 for place, scores in targets.items()}
        kept = {(place, t): First(n) for place, scores in targets.items() for t in scores}
        for row, ids, no_id, labels, units in _blocks(batches, tree.units.shape[1],
                                                      max(256, CELLS // len(tree.rows))):
            def wanted(place: int, low: np.ndarray, high: np.ndarray, equal: np.ndarray) -> np.ndarray:
                out = np.zeros(len(low), bool)
                for t, least, most in spans.get(place, ()):
                    out |= (high >= max(least, kept[place, t].least)) & (low <= most)
                return out & ~equal

            def scored(place: int, at: np.ndarray, score: np.ndarray) -> None:
                for t, least, most in spans.get(place, ()):
                    good = (score >= max(least, kept[place, t].least)) & (score <= most)
                    if good.any():
                        own = at[good]
                        kept[place, t].add(score[good], ids[own], no_id[own], row[own])

            descend(tree, units, labels, wanted, scored)
        yield _found_batch(kept)

    return _best(rows.mapInArrow(run, _FOUND), n)


# --- the job --------------------------------------------------------------------------

def with_flipped_labels(vectors: DataFrame, every: int = FLIPPED_EVERY,
                        classes: int = CLASSES) -> DataFrame:
    """Vectors whose id ``every`` divides move to the next label."""
    flipped = F.col("vec_id") % every == 0
    moved = ((F.col("label") + 1) % classes).cast(vectors.schema["label"].dataType)
    return vectors.withColumn("label", F.when(flipped, moved).otherwise(F.col("label")))


_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, "
           "positive_score long, negative_score long")


def mined(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, n_positives: int = POSITIVES,
          n_negatives: int = NEGATIVES, low_share: int = LOW, high_share: int = HIGH,
          max_anchors: int = MAX_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row per anchor, positive and negative; several if ids repeat."""
    spark = vectors.sparkSession
    rows = scaled(vectors)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    out = None
    for width, n in sorted(anchors.groupBy("width").agg(F.count("*")).collect()):
        size = max(1, min(max_anchors, MAX_ANCHOR_BYTES // (8 * max(width, 1))))
        groups = math.ceil(n / size)
        alike = rows.where(F.col("width") == width).select("row", "vec_id", "label", "units")
        for group in range(groups):
            chosen = (anchors.where(F.col("width") == width)
                      .where(F.pmod(F.xxhash64("row"), F.lit(groups)) == group)
                      .select("row", "vec_id", "label", "units").collect())
            if not chosen:
                continue
            tree = spanning_tree(chosen)
            close = positives(alike, tree, n_positives)
            targets: dict[int, list[int]] = {}
            for r in close:
                targets.setdefault(r.place, [])
                if r.score not in targets[r.place]:
                    targets[r.place].append(r.score)
            asked = spark.createDataFrame(
                [(r.place, int(tree.ids[r.place]), r.vec_id, r.score) for r in close],
                "place int, anchor_id long, positive_id long, target long")
            found = negatives(alike, tree, targets, n_negatives, low_share, high_share)
            part = (found.select("place", "target", "rank", F.col("vec_id").alias("negative_id"),
                                 F.col("score").alias("negative_score"))
                    .join(F.broadcast(asked), ["place", "target"])  # a few rows an anchor
                    .select("anchor_id", "positive_id", "rank", "negative_id",
                            F.col("target").alias("positive_score"), "negative_score"))
            part = cut_lineage(part, "hard-negatives") if groups > 1 else part
            out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], _RESULT) if out is None else out


def report(vectors: DataFrame) -> DataFrame:
    """The query over the given table."""
    return mined(with_flipped_labels(vectors))


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % {FLIPPED_EVERY} = 0 THEN (label + 1) % {CLASSES} ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS al, c.r AS cr, c.vec_id, c.label,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, c.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.q) = len(c.q) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (
  SELECT ar, anchor_id, cr, vec_id AS positive_id, score AS positive_score
  FROM s WHERE label = al
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, cr) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.ar, p.cr
            ORDER BY score DESC, vec_id NULLS LAST, s.cr) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND s.label <> s.al
  AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
