"""Embedding links against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from newsloom.llm import embeddings


def brute(rows: list[tuple], threshold: float = 0.93) -> list[tuple]:
    def usable(v):
        return v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 24

    n = len(rows)
    units = [np.array(v, float) / np.abs(v).max() if usable(v) else None for _, v, _ in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    root, degree = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (units[i] is not None and units[j] is not None and rows[i][2] is not None
                    and rows[i][2] == rows[j][2] and units[i] @ units[j] >= threshold):
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[find(i)] = min(least.get(find(i), vec_id), vec_id)
    out = [(v, degree[i], least.get(find(i))) for i, (v, _, _) in enumerate(rows)]
    return sorted(((v, d, c, v is not None and v == c) for v, d, c in out), key=str)


def vectors(seed: int, n: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    rows: list[tuple] = []
    for i in range(n):
        if rows and i % 3:
            base = np.array(rows[draw.integers(len(rows))][1])
            v = base + draw.normal(size=24) * draw.choice([0.0, 0.02, 0.04])
        else:
            v = draw.normal(size=24) / 5
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(draw.integers(3))))
    return rows


ODD = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] + [1.0] * 23, 1), (903, [None] + [1.0] * 23, 1),
       (904, [1.0] * 24, None), (905, [1.0] * 24, None), (906, [1.0, 2.0], 1), (907, [], 1),
       (908, [float("inf")] * 24, 1), (909, [1e30] * 24, 2), (910, [2e-30] * 24, 2), (None, [1.0] * 24, 2),
       (911, [5.0] * 24, 2), (911, [5.0] * 24, 2)]
SCHEMA = "vec_id long, embedding array<float>, label int, code string, unit int, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "n") for r in rows], SCHEMA).repartition(3)


def collect(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("block", [4, 2048])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "GROUP_ROWS", 200)
    rows = vectors(0, 160) + ODD
    assert collect(embeddings.linked(frame(spark, rows))) == brute(rows)


def test_recall_near_the_threshold(spark):
    """Pairs of cosine 0.93 to 0.95: at least nine in ten are found, none below."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(300):
        a = draw.normal(size=24)
        a /= np.linalg.norm(a)
        b = draw.normal(size=24)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = draw.uniform(0.931, 0.95)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist(), 1)]
    found = {v: n for v, n, _, _ in collect(embeddings.linked(frame(spark, rows)))}
    expected = {v: n for v, n, _, _ in brute(rows)}
    assert all(found[v] <= expected[v] for v in found)
    assert sum(found.values()) >= 0.9 * sum(expected.values())


def test_recall_with_a_common_direction(spark):
    """Vectors that share most of their length: links are found as well."""
    draw = np.random.default_rng(12)
    common = draw.normal(size=24)
    common *= np.sqrt(0.8) / np.linalg.norm(common)
    rows = []
    for i in range(300):
        a = draw.normal(size=24)
        a = common + np.sqrt(0.2) * a / np.linalg.norm(a)
        a /= np.linalg.norm(a)
        b = draw.normal(size=24)
        b -= (a @ b) * a
        cosine = draw.uniform(0.931, 0.95)
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), i), (2 * i + 1, b.tolist(), i)]
    found = sum(r[1] for r in collect(embeddings.linked(frame(spark, rows))))
    assert found >= 0.99 * sum(r[1] for r in brute(rows))


def test_rotation_balances_the_bits():
    draw = np.random.default_rng(1)
    units = draw.normal(size=(3000, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes = embeddings.fit_rotation(units).codes(units)
    bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1)
    assert (np.abs(bits.mean(axis=0) - 0.5) < 0.1).all()


def test_empty(spark):
    assert collect(embeddings.linked(frame(spark, []))) == []
    assert collect(embeddings.linked(frame(spark, [(1, None, 1)]))) == [(1, 0, 1, True)]
