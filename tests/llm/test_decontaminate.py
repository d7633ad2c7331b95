"""Decontamination against SQL and against a plain scan of windows."""

from __future__ import annotations

import hashlib
import re

import pytest

from newsloom.llm import decontaminate

ITEMS = "item_id long, text string, window long, words string, key string, doc_id int"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, "w", "k", 2) for i, t in texts], ITEMS)


def plain(docs, texts):
    out = []
    for doc_id, text in docs:
        own, hit, items = words(text), set(), set()
        for item, asked in texts:
            asked = words(asked)
            k = min(10, len(asked))
            for s in range(len(asked) - k + 1 if k else 0):
                for at in range(len(own) - k + 1):
                    if own[at:at + k] == asked[s:s + k]:
                        hit |= set(range(at, at + k))
                        items |= {str(item)} if item is not None else set()
        out.append((doc_id, len(own), len(hit), len(items),
                    hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [(1, "So: " + PASSAGE.upper() + "! and on"), (1, "so " + PASSAGE[4:] + " x"), (2, PASSAGE + " " + PASSAGE),
        (3, None), (4, ""), (5, "..."), (None, "x " + PASSAGE), (6, "a"), (7, "b a b a a"), (8, "É é ß"),
        (9, "one two three four five six seven eight nine"), (10, "r " * 40), (11, " leading seven. 中文🙂 mixed 7up"),
        (12, "ten eleven twelve"), (13, "r r r r r r r r r"), (14, "r " * 10 + "q " + "r " * 11)]
ASKED = [(1, PASSAGE), (2, "a"), (3, None), (4, ""), (5, "b  a"), (12, "ten, eleven; twelve"), (None, "é SS ß"),
         (30, "É"), (7, "r " * 25), (8, PASSAGE), (8, "中文🙂 mixed 7up"), (40, "one x two")]


@pytest.mark.parametrize("block_windows", [200_000, 2])
def test_equals_a_plain_scan(spark, block_windows, monkeypatch):
    monkeypatch.setattr(decontaminate.hits, "__defaults__",
                        decontaminate.hits.__defaults__[:-1] + (block_windows,))
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in DOCS],
                                 "doc_id long, text string, words string, start int, window int").repartition(3)
    assert got(decontaminate.report(docs, items_of(spark, ASKED))) == plain(DOCS, ASKED)


def test_equals_sql(spark, messy, in_sql, same):
    texts = [(i, t) for i, t in [(1, "w1x0 w2x1"), (2, "ababab"), (3, "éß 中文🙂 éß"), (4, "endoftext hi"), (5, "a b")]]
    texts += [(100 + i, r.text) for i, r in enumerate(messy.where("doc_id in (8, 9)").collect())]
    items = items_of(spark, texts)
    expected = in_sql(decontaminate.SQL,
                      documents=messy.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}),
                      benchmark=items.select("item_id", "text").toPandas().astype({"item_id": "Int64"}))
    same(decontaminate.report(messy, items), expected)


def test_rarest_shingle_is_the_prefix(spark):
    docs = spark.createDataFrame([(i, "the end of it all is near") for i in range(9)], "doc_id long, text string")
    windows, _ = decontaminate.windows_of(items_of(spark, [(1, "the end of it but later on")]), "item_id", "text", 10)
    texts = docs.select("doc_id", docs["doc_id"].alias("doc_row"),
                        decontaminate.padded_words(docs["text"]).alias("words"))
    row = decontaminate._rarest(texts, windows, [3], 1).first()
    assert row["shift"] == 2  # "of it but" is in no document, the two before it are in all


def test_empty_tables(spark, messy, no_docs):
    assert decontaminate.report(no_docs, items_of(spark, ASKED)).count() == 0
    clean = decontaminate.report(messy, items_of(spark, []))
    assert clean.count() == messy.count() and clean.where("contaminated or n_hit > 0 or n_items > 0").count() == 0


def test_no_python_in_the_plan(spark, messy):
    frame = decontaminate.report(messy, items_of(spark, ASKED))
    assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().toString())


def test_many_items_and_copies(spark):
    """Documents that hold the same passage of many items share one list."""
    docs = spark.range(3000).selectExpr("id as doc_id", f"if(id % 3 = 0, '{PASSAGE}', concat('doc ', id)) as text")
    items = items_of(spark, [(i, PASSAGE + f" tail{i}") for i in range(50)])
    rows = decontaminate.report(docs, items).where("contaminated").collect()
    assert len(rows) == 1000 and {(r.n_items, r.n_hit, r.n_words) for r in rows} == {(50, 12, 12)}
