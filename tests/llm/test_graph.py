"""Connected components, numbering and the pipeline as a whole."""

from __future__ import annotations

import random

import pytest

from newsloom.llm.graph import components
from newsloom.operators.numbering import numbered


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(-90, 90), draw.randrange(-90, 90)) for _ in range(70)]
    links += [(1000 + i, 1001 + i) for i in range(50)] + [(5000, 6000 + i) for i in range(40)]
    links += links[:5] + [(7, 7)]
    root: dict[int, int] = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    assert len(got) == len(root)
    assert {r.node: r.component for r in got} == {n: find(n) for n in root}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def test_numbers_follow_the_order(spark):
    values = [None, *range(-40, 300, 3)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert [r.v for r in numbered(df, ["v"], "test").orderBy("position").collect()] == values
