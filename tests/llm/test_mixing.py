"""Mixing against its SQL statement and by hand."""

from __future__ import annotations

import pandas as pd
import pytest

from newsloom.llm import mixing


def frame(df) -> pd.DataFrame:
    out = pd.DataFrame([tuple(r) for r in df.select("doc_id", "text", "source").collect()],
                       columns=["doc_id", "text", "source"])
    return out.astype({"doc_id": "Int64"})


def test_matches_sql_on_messy_documents(messy, in_sql, same):
    """Rows that share an id draw for themselves, so only what is fixed for them is compared."""
    got = mixing.report(messy)
    shared = {r.again for r in mixing.repeated_ids(messy, "doc_id").collect()}
    assert shared and got.count() == messy.count()
    once = [r for r in got.collect() if r.doc_id not in shared]
    where = "doc_id IN (" + ",".join(str(r.doc_id) for r in once) + ")"
    wanted = f"SELECT * FROM ({mixing.SQL}) WHERE {where}"
    same(got.where(where), in_sql(wanted, documents=frame(messy)))


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_of_one_id_draw_for_themselves(spark, doc_id):
    rows = [(doc_id, "w " * 100, "a") for _ in range(400)] + [(i, "w " * 100, "b") for i in range(1000, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.report(docs).where("doc_id IS NULL OR doc_id < 1000").collect()
    target, taken = got[0].target, sum(r.taken for r in got)
    assert len(got) == 400 and abs(taken - target) < 0.15 * target
    assert {r.taken for r in got} <= {0, 100}


@pytest.mark.parametrize("sizes", [[5000, 1, 1, 1], [10, 20, 30, 40], [0, 0]])
def test_targets_fill_up_to_the_limit(spark, in_sql, same, sizes):
    docs = spark.createDataFrame([(i, "w " * n, f"s{i}") for i, n in enumerate(sizes)],
                                 "doc_id long, text string, source string")
    same(mixing.report(docs), in_sql(mixing.SQL, documents=frame(docs)))
    rows = {r.doc_id: r for r in mixing.report(docs).collect()}
    assert sum(r.target for r in rows.values()) == pytest.approx(sum(sizes))
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in rows.values())
    open_levels = {round(r.target / (i % 3 + 1), 6) for i, r in rows.items()
                   if r.target < 3 * r.source_size - 1e-6}
    assert len(open_levels) <= 1


def test_taken_words_come_near_the_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{i % 4 if i % 3 else 0}")
                                  for i in range(6000)], "doc_id long, text string, source string")
    got = mixing.report(docs)
    by_source = {}
    for r in got.collect():
        taken, target = by_source.get(r.source_size, (0, r.target))
        by_source[r.source_size] = (taken + r.taken, target)
        assert r.taken <= 3 * r.size
    assert all(abs(taken - target) < 0.08 * target for taken, target in by_source.values())
    assert sorted(got.collect()) == sorted(mixing.report(docs.repartition(5)).collect())


def test_mix_keeps_all_columns(messy):
    mix = mixing.mixed(messy)
    assert mix.schema == messy.schema
    plan = {(r.doc_id, r.taken) for r in mixing.report(messy).collect()}
    assert all(any(i == r.doc_id and t for i, t in plan) for r in mix.collect())


def test_empty(no_docs):
    assert mixing.report(no_docs).collect() == []
    assert mixing.mixed(no_docs).collect() == []
