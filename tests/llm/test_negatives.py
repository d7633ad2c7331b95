"""Hard negatives against SQL, and the bounds of the tree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row

from newsloom.llm import negatives

SCHEMA = ("vec_id long, embedding array<float>, label int, row string, score int, units string, "
          "place int, rank int, width int, target int")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "u", 2, 3, 4, 5) for r in rows], SCHEMA)


def drawn(n, width=8, seed=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, width))
    return [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.4 * draw.normal(size=width)], i % 4)
            for i in range(n)]


ODD = [(700, None, 1), (701, [1.0, None] * 4, 1), (702, [math.nan] * 8, 1), (800, [math.inf] * 8, 1),
       (900, [0.5] * 8, None), (None, [1.0] * 8, 2), (None, [2.0] * 8, 2), (1000, [1.0, 2.0], 1),
       (1001, [1.0, 2.0], 1), (1002, [1.0, 2.0], 3), (1100, [], 1), (1101, [], 1), (1200, [0.0] * 8, 1),
       (1300, [float(np.float32(3e38))] * 8, 1), (7, [0.25] * 8, 9), (14, [0.25] * 8, 9)]


def expected(in_sql, rows):
    rows = [r for r in rows if r[0] != 1300]  # its products do not fit
    table = pd.DataFrame({"vec_id": pd.array([r[0] for r in rows], "Int64"),
                          "embedding": [r[1] for r in rows], "label": pd.array([r[2] for r in rows], "Int32")})
    return in_sql(negatives.SQL, embeddings=table)


@pytest.mark.parametrize("max_anchors", [4096, 2])
def test_equals_sql(spark, in_sql, same, max_anchors):
    rows = drawn(640) + ODD + [(i, v, k) for i, v, k in drawn(40, seed=5)[1:30]]
    table = negatives.with_flipped_labels(frame(spark, rows)).repartition(5)
    same(negatives.mined(table, max_anchors=max_anchors), expected(in_sql, rows))


def test_equal_scores_go_by_id(spark):
    rows = [(100, [1.0, 0.0], 1)] + [(i, [1.0, 0.0], 1) for i in range(9, 1, -1) if i % 7]
    rows += [(i, [0.9, 0.0], 2) for i in range(40, 30, -1) if i % 7]
    got = negatives.report(frame(spark, rows).repartition(4)).orderBy("positive_id", "rank").collect()
    assert sorted({r.positive_id for r in got}) == [2, 3, 4, 5, 6]
    assert [r.negative_id for r in got[:5]] == [31, 32, 33, 34, 36]
    assert {(r.positive_score, r.negative_score) for r in got} == {(256 * 256, 230 * 256)}


def test_bounds_hold_and_save_products():
    """Bounded scores are right, and close anchors need few products."""
    draw = np.random.default_rng(1)
    anchors = np.floor(256 * np.repeat(draw.normal(size=(4, 16)), 25, axis=0) + 3 * draw.normal(size=(100, 16)))
    tree = negatives.spanning_tree([Row(row=i, vec_id=i, label=0, units=a.tobytes())
                                    for i, a in enumerate(anchors)])
    assert sorted(tree.rows) == list(range(100)) and (tree.parent[1:] < np.arange(1, 100)).all()
    units = np.floor(256 * draw.normal(size=(500, 16)))
    scores = units @ tree.units.T
    floor = np.sort(scores, axis=0)[-10]
    seen = {}

    def wanted(place, low, high, equal):
        assert (low <= scores[:, place]).all() and (scores[:, place] <= high).all() and not equal.any()
        return high >= floor[place]

    def scored(place, at, score):
        assert (score == scores[at, place]).all()
        seen[place] = int((score >= floor[place]).sum())

    formed = negatives.descend(tree, units, np.ones(500), wanted, scored)
    assert seen == dict.fromkeys(range(100), 10)
    assert formed < 0.3 * 500 * 100


def test_long_vectors_are_multiplied_as_integers():
    one = np.full(4, 2.0**29 + 1)
    assert negatives.products(np.stack([one, -one]), one, 2.0**30, 2.0**30).tolist() == [
        4 * (2**29 + 1) ** 2, -4 * (2**29 + 1) ** 2]


def test_empty_tables(spark):
    assert negatives.report(frame(spark, [])).count() == 0
    assert negatives.report(frame(spark, [(1, [1.0], 1), (3, [1.0], 2)])).count() == 0
    assert negatives.report(frame(spark, [(100, [1.0], 1)])).count() == 0
