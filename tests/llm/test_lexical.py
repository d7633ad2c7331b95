"""Ranked lexical search against SQL and against a plain scan."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import Row

from newsloom.llm import lexical

ITEMS = "item_id long, text string, doc_id long, score long, rank int, term string"


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in texts], ITEMS)


def plain(docs, texts, top=20):
    """Rows (item_id, rank, doc_id, score) from a loop over items and documents."""
    cut = [(i, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in docs]
    n_docs = sum(1 for _, terms in cut if terms)
    all_terms = sum(len(terms) for _, terms in cut)
    held = Counter(t for _, terms in cut for t in set(terms))
    out = []
    for item, text in texts:
        asked = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text or ""))
        scores = []
        for i, terms in cut:
            tf = Counter(terms)
            m = 75 + 25 * len(terms) * n_docs // max(all_terms, 1)
            score = sum(lexical.weight(n_docs, held[t]) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in asked if tf[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


ASKED = [(1, "w1x0 w2x1 W2X1 w7x2"), (2, None), (3, ""), (None, "éß 中文🙂"), (1, "w5x1, w1x0"),
         (9, "x ab" + "ab" * 299 + " zzz"), (10, "É endoftext hi"), (11, ".,; \x00")]


@pytest.mark.parametrize("block_terms", [200_000, 3])
def test_equals_a_plain_scan(spark, messy, block_terms):
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    found = lexical.ranked(messy, items_of(spark, ASKED), block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == plain(docs, ASKED)


def test_equals_sql(messy, spark, in_sql, same):
    items = items_of(spark, ASKED)
    expected = in_sql(lexical.SQL, documents=messy.select("doc_id", "text").toPandas()
                      .astype({"doc_id": "Int64"}), benchmark=items.select("item_id", "text").toPandas()
                      .astype({"item_id": "Int64"}))
    same(lexical.ranked(messy, items), pd.DataFrame(expected))


def test_terms_across_slices(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 5)
    held = lexical.Items.of([Row(item_row=0, item_id=0, term=t, times=1)
                              for t in ("alpha", "b", "gamma")])
    data = b"alpha b  alphab gamma b".translate(lexical._LETTERS)
    assert sorted(lexical._hits(held.automaton(), data)) == [0, 1, 1, 2]
    assert sorted(lexical._hits(held.automaton(), b"")) == []
    assert lexical._length(data) == 5 and lexical._length(b"") == 0


def test_top_over_many_tasks_and_ties(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('apple ', if(id % 7 = 0, 'pear', 'fig')) "
                                       "as text").repartition(13)
    rows = lexical.ranked(docs, items_of(spark, [(1, "apple pear")]), top=5).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [0, 7, 14, 21, 28] and [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert len({r.score for r in rows}) == 1


def test_empty_tables(spark, messy, no_docs):
    assert lexical.ranked(no_docs, items_of(spark, ASKED)).count() == 0
    assert lexical.ranked(messy, items_of(spark, [])).count() == 0
    assert lexical.ranked(no_docs, items_of(spark, [])).count() == 0
