"""The pipeline: each stage does its work on what the stage before kept."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from newsloom.llm import bpe, queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Good texts, junk, exact and near copies, a shared passage and messy rows."""
    draw = random.Random(11)

    def prose(n):
        words = ["".join(draw.choice("aeiou") + draw.choice("lmnrst") for _ in range(draw.randrange(1, 4)))
                 for _ in range(n)]
        return ". ".join(" ".join(words[k:k + 11]).capitalize() for k in range(0, n, 11)) + "."

    passage = prose(70)
    rows, labels = [], []
    for i in range(200):
        good = i % 5 > 0
        text = prose(120) if good else "!! ".join(w.upper() for w in prose(120).split())
        if i in (51, 52, 53):
            text = prose(30) + " " + passage + " " + prose(30)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(good), 0))
    rows += [(300, rows[11][1], "en", "s0", 0), (301, rows[12][1].replace("a", "e", 1), "en", "s1", 0),
             (302, None, None, None, None), (303, "", "en", "s0", 0), (None, prose(40), "en", "s2", 9)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), passage


def test_stages(spark, tables, tmp_path):
    folder, passage = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs)
        if k < 4:
            assert docs.columns == columns
    ids = [{r.doc_id for r in d.collect()} for d in seen]
    good = {i for i in range(200) if i % 5}
    assert good <= ids[0] and not ids[0] & (set(range(200)) - good)
    assert good <= ids[1] and not ids[1] & {300, 301} and None in ids[1]
    cut = {r.doc_id: r for r in seen[2].collect()}
    assert all(passage not in cut[i].text and cut[i].n_chars == len(cut[i].text) for i in (51, 52, 53))
    assert cut[54].text == spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = 54").first().text
    texts = {r.doc_id: r.text for r in seen[3].collect()}
    for r in seen[4].collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert r.n_tokens == len(bpe.load(bpe.default_vocabulary()).encode(texts[r.doc_id] or "")) // 4


def test_run_agrees_with_itself(spark, tables):
    folder, _ = tables
    a, b = (sorted(str(tuple(r)) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2))
    assert a == b and a


def test_every_query_is_registered():
    names = list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(names) and "pipeline" in names
