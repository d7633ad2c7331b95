"""I-Match fingerprints against a plain calculation."""

from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from newsloom.llm import imatch

SPLIT = re.compile(imatch.BETWEEN)


def collect(df) -> list:
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("range_bytes", [1, 4000])
def test_edited_texts(messy, range_bytes):
    rows = messy.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(
        F.coalesce("text", F.lit(""))).alias("hash")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash))
    expected = []
    for r, after in zip(rows, rows[1:] + rows[:1]):
        half = len(r.text) // 2
        edited = r.text[:len(r.text) - half] + after.text[:half]
        expected.append((r.doc_id, len(r.text), hashlib.sha256(edited.encode()).hexdigest()))
    got = imatch.report(messy, range_bytes=range_bytes).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(expected, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def murmur(values, seed=42):
    """Spark's hash of an array of longs: 32-bit Murmur3, each value seeding the next."""
    mask = 0xFFFFFFFF

    def turn(x, by):
        return (x << by | x >> (32 - by)) & mask

    for value in values:
        h = seed
        for half in (value & mask, value >> 32 & mask):
            h ^= turn(half * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
            h = (turn(h, 13) * 5 + 0xE6546B64) & mask
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & mask
        h = (h ^ h >> 13) * 0xC2B2AE35 & mask
        seed = h ^ h >> 16
    return seed


@pytest.mark.parametrize("low, high", [(0.01, 0.2), (0.1, 0.5), (0.9, 1.0)])
def test_fingerprints_and_likeness_by_plain_calculation(messy, low, high):
    def terms(text):
        hashes = {xxhash.xxh64_intdigest(w.encode(), 42) for w in SPLIT.split(text.lower()) if w}
        return {h - (1 << 64) if h >> 63 else h for h in hashes}

    def parts(text):
        kept = sorted(terms(text) & known) or sorted(terms(text))
        chosen = ([h for h in kept if h & mask == value] for mask, value in imatch.subsets())
        return [murmur(own) if own else None for own in chosen]

    def shown(found):
        return "".join("-" * 8 if p is None else f"{p:08x}" for p in found)

    def alike(a, b):
        held = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in held) / len(held) if held else 1.0

    rows = messy.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(
        F.coalesce("text", F.lit(""))).alias("hash")).collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash))
    counts: dict[int, int] = {}
    for r in rows:
        for term in terms(r.text):
            counts[term] = counts.get(term, 0) + 1
    known = {t for t, n in counts.items() if low * len(rows) <= n <= high * len(rows)}
    expected = []
    for r, after in zip(rows, rows[1:] + rows[:1]):
        half = len(r.text) // 2
        own, edited = parts(r.text), parts(r.text[:len(r.text) - half] + after.text[:half])
        expected.append((r.doc_id, shown(own), shown(edited), alike(own, edited), alike(own, parts(after.text))))
    got = [(r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
           for r in imatch.report(messy, imatch.Band(low, high)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_starts_of_ranges_are_bounded_and_found(spark, monkeypatch):
    """Each row lies in the range of the last start that is not above it."""
    monkeypatch.setattr(imatch, "MAX_RANGES", 23)
    rows = spark.range(500).select(F.col("id"), F.xxhash64("id").alias("hash"), F.lit("text").alias("text"))
    ranges = imatch._ranges(rows, 1)
    assert 15 < len(ranges.starts) <= 23 and ranges.page == 4
    number, is_start = ranges.place()
    starts = [(s["id"], s["hash"]) for s in ranges.starts]
    for r in rows.select("id", "hash", number.alias("number"), is_start.alias("is_start")).collect():
        assert r.number == sum(s <= (r.id, r.hash) for s in starts) - 1
        assert r.is_start == ((r.id, r.hash) in starts)


def test_equal_texts_have_equal_fingerprints(messy):
    texts = {r.doc_id: r.text for r in messy.collect()}
    prints = {r.doc_id: r.fingerprint for r in collect(imatch.report(messy))}
    assert prints[5] == prints[6] and prints[3] == prints[4] == prints[14]
    assert prints[9] != prints[1] and len(prints[1]) == 8 * len(imatch.subsets())
    assert texts[5] == texts[6]


def test_lexicon_counts_all_documents(messy):
    band = imatch.Band(0.1, 0.5)
    rows = messy.select("text").collect()
    counts: dict[str, int] = {}
    for r in rows:
        for w in set(SPLIT.split((r.text or "").lower())) - {""}:
            counts[w] = counts.get(w, 0) + 1
    expected = {w: n for w, n in counts.items() if 0.1 * len(rows) <= n <= 0.5 * len(rows)}
    words = messy.sparkSession.createDataFrame([(w,) for w in expected], "word string")
    joined = imatch.lexicon(messy, band).join(words.withColumn("term", F.xxhash64("word")), "term").collect()
    assert {r.word: r.frequency for r in joined} == expected
    assert imatch.lexicon(messy, band).count() == len(expected)


def test_both_ways_to_the_lexicon_agree(messy, monkeypatch):
    one = collect(imatch.report(messy))
    monkeypatch.setattr(imatch, "LITERAL_TERMS", 0)
    assert collect(imatch.report(messy)) == one


def test_half_edited_texts_are_nearer_than_others(spark):
    words = "|".join(f"t{i}" for i in range(900)).split("|")
    docs = spark.createDataFrame([(i, " ".join(words[(i * 37 + k * 7) % 900] for k in range(120)))
                                  for i in range(80)], "doc_id long, text string")
    rows = collect(imatch.report(docs))
    assert sum(r.near_edited for r in rows) > 2 * sum(r.near_next for r in rows)


@pytest.mark.parametrize("texts", [["only one"], [None, "a"]])
def test_few_documents(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = collect(imatch.report(docs))
    assert len(rows) == len(texts) and all(r.near_next == float(len(texts) == 1) for r in rows)


def test_main_path_is_native(messy):
    plan = imatch.report(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(no_docs):
    assert imatch.report(no_docs).collect() == []
