"""The quality classifier: held-out accuracy, and messy input."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import quality


def _text(draw: random.Random, good: bool, i: int) -> str:
    words = [f"{'stream river mountain letter table'.split()[draw.randrange(5)]}{'' if draw.random() < 0.7 else 's'}"
             for _ in range(60)]
    if good:
        return ". ".join(" ".join(words[k:k + 9]).capitalize() for k in range(0, 60, 9)) + "."
    kind = i % 3
    return ("!! ".join(w.upper() for w in words) if kind == 0 else " ".join(f"{w}$$$" for w in words) if kind == 1
            else " ".join([words[0]] * 60))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(6)
    rows = [(i, _text(draw, i % 4 > 0, i), "labelled", i % 9) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, label int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(600)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = quality.scored(docs, quality.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.quality for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_are_never_learned_from(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()


def test_sample_is_bounded(corpus):
    docs, labels = corpus
    assert len(quality.fit(docs, labels, max_labelled=37).labels) == 37


def test_votes_equal_brute_force(corpus):
    docs, labels = corpus
    voters = quality.fit(docs, labels, max_labelled=50)
    for r in docs.limit(20).collect():
        v = voters.latent(quality.shares(r.text)[None])[0]
        cosines = voters.vectors @ v
        near = np.argsort(-cosines, kind="stable")[:quality.NEIGHBOURS]
        w = np.maximum(cosines[near].astype(float), 0) ** quality.POWER
        score = voters.scores(quality.shares(r.text)[None])[0]
        assert score == pytest.approx((w * voters.labels[near]).sum() / w.sum(), abs=1e-3)


def test_messy_documents(messy, spark):
    labels = spark.createDataFrame([(i, i % 2 if i % 5 else None, None) for i in range(-5, 17)] + [
        (1, 0, 0), (None, 1, 1), (2**62, 1, 0)], "doc_id long, quality int, toxic int")
    voters = quality.fit(messy, labels)
    rows = quality.scored(messy, voters).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    kept = quality.kept(messy, voters)
    assert kept.schema == messy.schema
    assert kept.count() == sum(r.predicted for r in rows)


def test_empty_and_without_labels(messy, no_docs, corpus, spark):
    _, labels = corpus
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in quality.scored(messy, quality.fit(messy, none)).collect()} == {0.5}
    assert quality.scored(no_docs, quality.fit(no_docs, labels)).collect() == []


@pytest.mark.parametrize("text", [
    "a bb  a a\n" * 40, " lead a a b", "x" * 100, "", " ", "éß 中文 🙂 éß éß 中文!! " * 9, "tail cut wordword"])
def test_shares_do_not_depend_on_slices(monkeypatch, text):
    whole = quality.shares(text)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(quality, "_SLICE", size)
        assert (quality.shares(text) == whole).all()


def test_long_repeated_list_counts_as_repeated():
    words = " ".join(f"w{i}" for i in range(150_000))
    once, twice = quality.shares(words), quality.shares(words + " " + words)
    assert len(words) > quality._SLICE
    assert once[-1] == 0 and twice[-1] == 0.5
