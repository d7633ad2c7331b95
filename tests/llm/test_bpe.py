"""BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from newsloom.llm import bpe

PATH = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text: str) -> list[int]:
    return np.frombuffer(bpe.load(PATH).encode(text), "<u4").tolist()


def test_random_texts(library):
    draw = random.Random(0)
    pools = ["abc de", " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ", "éàß中文字日本語", "🙂🏽‍", "019٣½²",
             "'s't're'LL!!#$%", "<|endoftext|>", "THEthe "]
    for _ in range(1500):
        text = "".join(draw.choice(draw.choice(pools)) for _ in range(draw.randrange(120)))
        text += "<|endoftext|>" if draw.random() < 0.2 else ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(text) == ids, text
        assert bpe.load(PATH).decode(np.asarray(ids, "<u4").tobytes()) == library.decode(
            ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 500 + "é" * 400, " " * 700 + "x", "the" * 2000])
def test_long_words_take_the_heap_and_agree(library, text):
    codec = bpe.load(PATH)
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids
    word = text[:90].encode()
    assert codec.merge_short(word) == codec.merge_long(word)


def test_messy_documents(messy, library):
    rows = bpe.encoded(messy).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    expected = []
    for r in messy.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((str(r.doc_id), len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(expected)


def test_decoded_column(messy):
    back = bpe.decoded(bpe.encoded(messy))
    assert sorted(r.decoded for r in back.collect()) == sorted(r.text or "" for r in messy.collect())


def test_empty(no_docs):
    assert bpe.encoded(no_docs).collect() == []


def test_words_in_use_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 4)
    codec = bpe.load.__wrapped__(bpe.default_vocabulary())
    merged = []
    plain = codec.merge_short
    codec.merge_short = lambda raw: merged.append(raw) or plain(raw)
    lib = Tokenizer.from_file(bpe.default_vocabulary())
    for text in ("x hot a b c d e f hot g h end", "one two\n three", " two", "two ", "a  b", "a\n b\n", "end\n"):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == lib.encode(
            text, add_special_tokens=False).ids, text
    assert merged.count(b" hot") == 1


def test_words_followed_by_signs(library):
    codec = bpe.load.__wrapped__(PATH)
    for text in ("a word, then. word,, ...word word?!; 3, don't, x", "on, on, on,\non, on ,on :on: 'on', éa, éa,. end!",
                 "a .\n, b,\tc, d,\u00a0e, f,", "and <|endoftext|>, and<|endoftext|>. and, and"):
        for _ in range(2):  # anew, and from the caches
            assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(
                text, add_special_tokens=False).ids, text


def test_full_caches_leave_a_worker_small():
    """Memory that a worker of its own takes for a codec and ever new words."""
    run = """
import random, re
from newsloom.llm import bpe
def mb():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
draw, before = random.Random(1), mb()
codec = bpe.load(bpe.default_vocabulary())
for k in range(600):
    codec.encode(" ".join("".join(draw.choices("abdeilmnorstu", k=9)) + ("", "", ",", "é", "...")[i % 5] for i in range(1000)))
print(mb() - before)
"""
    done = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, check=True)
    assert float(done.stdout) < 75, done.stdout
