"""Near-duplicate embeddings by iterative quantisation.

A rotation of the principal directions is learned on a bounded sample, such
that the signs of the rotated vectors are balanced binary codes.  The code is
cut into eight segments; vectors with the same label that agree in one segment
meet in a table of that segment (so all pairs that differ in up to seven bits
meet, and most that differ in more).  Pairs whose codes are near are ranked
with the original vectors in double precision, and linked at the threshold.

Equal vectors are one node with a count.  A crowded table entry is cut into
blocks, and pairs of blocks are compared by different tasks.  A task hands on
sums and a spanning forest of the links it found, never the pairs.

Defined cases: vectors that are null, zero, hold null or non-finite components
or have another length than most of the sample, and vectors without a label,
link with nothing and are their own component; equal vectors link; repeated
rows are vectors of their own; a null id is never the smallest; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import components

THRESHOLD = 0.93
#: Vectors that the rotation is learned on, chosen by the hash of their ids.
MAX_SAMPLE = 20_000
SEGMENTS, SEGMENT_BITS = 8, 8
#: Codes of a linked pair differ in fewer bits; cosine 0.93 means 7.7 of 64 on average.
MAX_BITS = 24
#: Members of a table entry that are compared in one piece, and rows of a task's group.
BLOCK, GROUP_ROWS = 2048, 8192
_BITS = SEGMENTS * SEGMENT_BITS
#: Tables and bits of each, from cheap to exact (one table of all vectors of a label),
#: the share of measured links that must meet, and how many are enough to measure it.
LAYOUTS = ((SEGMENTS, SEGMENT_BITS), (10, 6), (16, 4), (1, 0))
RECALL, QUERIES, LEAST_LINKS = 0.999, 4000, 100


@dataclass(frozen=True)
class Rotation:
    """Centre and projection that turn a unit vector into a code."""

    centre: np.ndarray
    projection: np.ndarray
    segments: int = SEGMENTS
    segment_bits: int = SEGMENT_BITS
    max_bits: int = MAX_BITS

    def codes(self, units: np.ndarray) -> np.ndarray:
        signs = (units - self.centre) @ self.projection > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()


def fit_rotation(units: np.ndarray, rounds: int = 50) -> Rotation:
    """Iterative quantisation: alternate between the nearest signs and the
    rotation that fits them best.  If there are fewer directions than bits,
    random combinations of them fill the code."""
    width = units.shape[1]
    random = np.random.default_rng(5)
    centre = units.mean(axis=0) if len(units) else np.zeros(width)
    moved = units - centre
    _, directions = np.linalg.eigh(moved.T @ moved)
    directions = directions[:, ::-1][:, :_BITS]
    used = directions.shape[1]
    rotation = np.linalg.qr(random.normal(size=(used, used)))[0]
    projected = moved @ directions
    for _ in range(rounds if len(units) else 0):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        rotation = (left @ right).T
    projection = directions @ rotation
    if used < _BITS:
        projection = np.hstack([projection, projection @ random.normal(size=(used, _BITS - used))])
    return Rotation(centre, projection)


def _units(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (double) of the usable rows, and which rows these are."""
    rows, usable = [], np.zeros(len(column), bool)
    for i, x in enumerate(column.to_pylist()):
        if x is not None and len(x) == width and None not in x:
            v = np.array(x, float)
            top = np.abs(v).max(initial=0)
            if np.isfinite(top) and top > 0:
                v = v / top
                rows.append(v / np.sqrt(v @ v))
                usable[i] = True
    return (np.stack(rows) if rows else np.zeros((0, width))), usable


def laid_out(rotation: Rotation, units: np.ndarray, labels: list, threshold: float) -> Rotation:
    """The rotation with the cheapest layout whose tables bring together the
    linked pairs of a sample, by brute force over some of it.  If the sample
    holds few links, pairs just at the threshold are made from its vectors."""
    codes = rotation.codes(units) if len(units) else np.zeros(0, np.uint64)
    kinds = np.unique([str(x) for x in labels], return_inverse=True)[1] if labels else np.zeros(0, int)
    apart = [np.zeros(0, np.uint64)]
    for first in range(0, min(QUERIES, len(units)), 256):
        rows = np.arange(first, min(first + 256, QUERIES, len(units)))
        near = (units[rows] @ units.T >= threshold) & (kinds[rows][:, None] == kinds[None, :])
        r, c = np.nonzero(near & (np.arange(len(units)) > rows[:, None]))
        different = (units[rows[r]] != units[c]).any(axis=1)
        apart.append((codes[rows[r]] ^ codes[c])[different])
    if sum(map(len, apart)) < LEAST_LINKS and len(units) and units.shape[1] > 1:
        base = units[np.arange(QUERIES) % len(units)]
        turn = np.random.default_rng(8).normal(size=base.shape)
        turn -= (turn * base).sum(axis=1, keepdims=True) * base
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        apart.append(rotation.codes(base) ^ rotation.codes(
            threshold * base + math.sqrt(max(0.0, 1 - threshold**2)) * turn))
    links = np.concatenate(apart)
    bits = np.bitwise_count(links).astype(int)
    max_bits = min(_BITS, max(MAX_BITS, int(bits.max(initial=0)) + 8))
    for segments, width in LAYOUTS:
        mask = np.uint64((1 << width) - 1)
        meet = np.zeros(len(links), bool)
        for k in range(segments):
            meet |= (links >> np.uint64(width * k) & mask) == 0
        if not len(links) or meet.mean() >= RECALL:
            break
    return replace(rotation, segments=segments, segment_bits=width,
                   max_bits=_BITS if width == 0 else max_bits)


def fit(vectors: DataFrame, max_sample: int = MAX_SAMPLE, threshold: float = THRESHOLD) -> Rotation | None:
    """Learn the rotation on at most ``max_sample`` usable vectors."""
    rows = (vectors.where("embedding is not null and size(embedding) > 0")
            .select("vec_id", "embedding", "label").orderBy(F.xxhash64("vec_id")).limit(max_sample)
            .select("embedding", "label").collect())
    if not rows:
        return None
    lengths = np.array([len(r.embedding) for r in rows])
    width = int(np.bincount(lengths).argmax())
    units, usable = _units(pa.array([r.embedding for r in rows]), width)
    rotation = fit_rotation(units if width else np.zeros((0, 0)))
    return laid_out(rotation, units, [r.label for r, u in zip(rows, usable) if u], threshold)


def coded(vectors: DataFrame, rotation: Rotation) -> DataFrame:
    """vec_id, label, unit (doubles as bytes) and code; null where not usable."""
    width = len(rotation.centre)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, usable = _units(batch.column(2), width)
            raw, codes = iter(units), iter(rotation.codes(units).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([next(raw).tobytes() if u else None for u in usable], pa.binary()),
                 pa.array([next(codes) if u else None for u in usable], pa.int64())],
                ["vec_id", "label", "unit", "code"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kind}, label {label}, unit binary, code long")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places can reach over links a-b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_pairs(codes: np.ndarray, units: np.ndarray, upper: np.ndarray, crossing: bool,
               segment: int, threshold: float, segment_bits: int = SEGMENT_BITS,
               max_bits: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of a table entry that meet here first: pairs that agree in
    an earlier segment are left to it.  If ``crossing``, only pairs of a row of
    the upper block with one of the lower block."""
    left = np.nonzero(~upper)[0] if crossing else np.arange(len(codes))
    right = np.nonzero(upper)[0] if crossing else left
    step = max(1, (1 << 20) // max(1, len(right)))
    for first in range(0, len(left), step):
        rows = left[first:first + step]
        apart = codes[rows][:, None] ^ codes[right][None, :]
        good = np.bitwise_count(apart) <= max_bits
        for s in range(segment):
            good &= (apart >> np.uint64(segment_bits * s) & np.uint64((1 << segment_bits) - 1)) != 0
        if not crossing:
            good &= right[None, :] > rows[:, None]
        r, c = np.nonzero(good)
        for at in range(0, len(r), 1 << 16):
            a, b = rows[r[at:at + (1 << 16)]], right[c[at:at + (1 << 16)]]
            linked = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
            if linked.any():
                yield a[linked], b[linked]


def _linked(nodes: DataFrame, threshold: float, rotation: Rotation) -> DataFrame:
    """(node, links, root) from every table entry: vectors linked, and a node of
    its tree in the entry's forest."""
    segment = [F.shiftrightunsigned("code", rotation.segment_bits * s).bitwiseAND(
        F.lit((1 << rotation.segment_bits) - 1)) for s in range(rotation.segments)]
    segment_bits, max_bits = rotation.segment_bits, rotation.max_bits
    entries = nodes.select("node", "label", "times", "unit", "code", F.posexplode(
        F.array(*segment)).alias("segment", "value"))
    keys = ["label", "segment", "value"]
    crowded = entries.groupBy(*keys).agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    cells = (entries.join(crowded, keys).withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("node", "times", "unit", "code", *keys,
                     F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     (F.col("own") > F.col("other")).alias("upper")))
    total = nodes.count() * rotation.segments
    groups = max(1, math.ceil(total / GROUP_ROWS))
    cells = cells.withColumn("cell", F.xxhash64(*keys, "low", "high")).withColumn(
        "grp", F.pmod(F.col("cell"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        names = [*keys, "low", "high"]
        table = table.sort_by([(k, "ascending") for k in [*names, "node"]])
        arrays = [table.column(k).to_numpy(zero_copy_only=False) for k in names]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in arrays], axis=0)
        starts = np.append(np.nonzero(new)[0], table.num_rows)
        node, times = table.column("node").to_numpy(), table.column("times").to_numpy()
        codes = table.column("code").to_numpy().view(np.uint64)
        raw = table.column("unit").combine_chunks().to_pylist()
        upper = table.column("upper").to_numpy()
        _, segments, _, low, high = arrays
        out_node, out_links, out_root = [], [], []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a < 2:
                continue
            units = np.frombuffer(b"".join(raw[a:b]), np.float64).reshape(b - a, -1)
            found = list(near_pairs(codes[a:b], units, upper[a:b], bool(low[a] < high[a]),
                                    int(segments[a]), threshold, segment_bits, max_bits))
            if not found:
                continue
            x, y = (np.concatenate(p) for p in zip(*found))
            links = np.zeros(b - a, np.int64)
            np.add.at(links, x, times[a:b][y])
            np.add.at(links, y, times[a:b][x])
            hit = np.nonzero(links)[0]
            out_node.append(node[a:b][hit])
            out_links.append(links[hit])
            out_root.append(node[a:b][forest(b - a, x, y)[hit]])

        def joined(parts: list) -> np.ndarray:
            return np.concatenate(parts) if parts else np.zeros(0, np.int64)

        return pa.table({"node": joined(out_node), "links": joined(out_links),
                         "root": joined(out_root)})

    return cells.groupBy("grp").applyInArrow(run, "node long, links long, root long")


def linked(vectors: DataFrame, threshold: float = THRESHOLD,
           rotation: Rotation | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rotation = rotation or fit(vectors, threshold=threshold)
    if rotation is None:
        alone = vectors.select("vec_id")
        return alone.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                            F.col("vec_id").alias("component_id"),
                            F.col("vec_id").isNotNull().alias("kept"))
    node = F.when(F.col("unit").isNotNull() & F.col("label").isNotNull(),
                  F.xxhash64("label", "unit"))
    rows = cut_lineage(coded(vectors, rotation).withColumn("node", node), "codes")
    nodes = cut_lineage(rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"),
        F.first("code").alias("code"), F.count("*").alias("times"),
        F.min("vec_id").alias("first_id")), "vectors")
    found = cut_lineage(_linked(nodes, threshold, rotation), "embedding-links")
    trees = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")),
                       "embeddings").select(F.col("node").alias("tree_node"), "component")
    links = found.groupBy(F.col("node").alias("linked_node")).agg(F.sum("links").alias("links"))
    labelled = (nodes.select("node", "times", "first_id")
                .join(links, F.col("node") == F.col("linked_node"), "left")
                .join(trees, F.col("node") == F.col("tree_node"), "left")
                .select("node", "first_id",
                        (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "node").alias("component")))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_node = labelled.join(least, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS n_links,
       min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""
