"""Removal of repeated strings against brute force over all windows."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import suffixes


def brute(rows: list[tuple], length: int = 200) -> list[tuple]:
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(docs, **options) -> list[tuple]:
    rows = suffixes.report(docs, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [1, 3000])
def test_messy_documents(messy, monkeypatch, chunk_bytes):
    stored = suffixes._stored_chunks
    monkeypatch.setattr(suffixes, "_stored_chunks", lambda d, t, c: stored(d, t, chunk_bytes))
    assert got(messy) == brute([(r.doc_id, r.text) for r in messy.collect()])


def test_passages_of_every_offset(spark, monkeypatch):
    draw = np.random.default_rng(0)
    letters = np.array(list("abcdefghij "))
    passage = "".join(draw.choice(letters, 260))
    rows = []
    for i in range(140):  # lengths around the limit, at every remainder of the cover's period
        body = "".join(draw.choice(letters, i)) + passage[: 190 + i % 25] + "".join(draw.choice(letters, 40))
        rows.append((i, body))
    rows += [(900, "z" * 450), (901, "z" * 199), (902, passage[60:]), (903, "é" * 150 + passage)]
    stored = suffixes._stored_chunks
    monkeypatch.setattr(suffixes, "_stored_chunks", lambda d, t, c: stored(d, t, 2000))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(docs) == brute(rows)


def test_documents_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_SLICE", 4096)
    suffixes._tables.cache_clear()
    draw = np.random.default_rng(1)
    long = "".join(draw.choice(list("abcdef"), 30000))
    rows = [(1, long), (2, "x" * 50 + long[4000:9000] + "y"), (3, long[8100:8310])]
    try:
        # Workers fork after the change in local mode only; the functions are tested in place as well.
        data = np.frombuffer(long.encode(), np.uint8)
        starts = np.arange(0, len(data) - 200)
        prints = suffixes.window_prints(data, starts, 200)
        again = suffixes.window_prints(data[4000:9000], np.arange(0, 4800), 200)
        assert (prints[4000:8800] == again).all() and len(set(prints.tolist())) == len(prints)
        assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    finally:
        suffixes._tables.cache_clear()


def test_cover_is_a_perfect_difference_cover():
    differences = Counter((a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER if a != b)
    assert set(differences) == set(range(1, suffixes.PERIOD)) and set(differences.values()) == {1}


def test_texts_keep_their_columns_and_lose_repeats(messy):
    out = suffixes.deduplicated(messy)
    assert out.schema == messy.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[5].text == "" and rows[6].text == "" and rows[-5].text == messy.where("doc_id = -5").first().text
    assert rows[3].text is None and rows[4].text == "" and rows[5].n_chars == 7


def test_texts_do_not_move_again(messy):
    plan = suffixes.report(messy)._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan


def test_empty(no_docs):
    assert got(no_docs) == []
    assert suffixes.deduplicated(no_docs).collect() == []


def test_memory_of_a_chunk_that_repeats_as_a_whole():
    """What a worker takes for a chunk of two equal halves, beside the texts."""
    import tracemalloc

    half = np.random.default_rng(0).integers(97, 123, suffixes.CHUNK_BYTES // 2, dtype=np.uint8)
    batch = pa.record_batch({"text": pa.array([half.tobytes().decode(), half.tobytes().decode() + "x"])})
    chunk = suffixes.Chunk.open(suffixes._pack([batch]), "text")
    suffixes._tables()

    def answered(rows):
        return [(*row[:4], np.packbits(np.zeros(row[3], bool)).tobytes(),
                 np.packbits(np.ones(row[3], bool)).tobytes()) for row in rows]

    def table(rows):
        return pa.table(dict(zip(["chunk", "kind", "bucket", "n", "shared", "first"], zip(*rows))))

    tracemalloc.start()
    samples = suffixes.Entries.of(suffixes.window_prints(chunk.data, chunk.samples(), suffixes.WINDOW))
    documents = suffixes.Entries.of(chunk.document_prints(chunk.long_documents()))
    known = answered([*samples.rows(1, 0, 12, 4), *documents.rows(1, 1, 12, 8)])
    del samples, documents
    found = suffixes._candidates(chunk, table(known))
    assert len(found.suffixes) > 0.99 * suffixes.CHUNK_BYTES - 1000
    entries = suffixes.Entries.of(suffixes.window_prints(chunk.data, found.suffixes, suffixes.LENGTH))
    known += answered(entries.rows(1, 2, 12, 8))
    del entries, found
    removed = suffixes._removed(chunk, table(known))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert removed[:-1].all() and peak < 90 * suffixes.CHUNK_BYTES


def test_only_buckets_that_occur_make_rows():
    entries = suffixes.Entries.of(np.array([5, 5, 1 << 63, 7], np.uint64))
    rows = list(entries.rows(3, 0, 20, 8))
    assert [(r[2], r[3]) for r in rows] == [(0, 2), (1 << 19, 1)] and entries.repeated.tolist() == [True, False, False]
