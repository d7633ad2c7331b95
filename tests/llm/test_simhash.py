"""SimHash groups against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from newsloom.llm import simhash
from newsloom.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text: str | None, width: int) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_groups(prints: list[int], ids: list, max_bits: int) -> list:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                root[find(i)] = find(j)
    least: dict[int, object] = {}
    for i, doc_id in enumerate(ids):
        k = find(i)
        if doc_id is not None and (least.get(k) is None or doc_id < least[k]):
            least[k] = doc_id
    return [least.get(find(i)) for i in range(len(prints))]


def test_report_matches_brute_force(messy):
    rows = messy.collect()
    prints = [brute_print(r.text, 3) for r in rows]
    groups = brute_groups(prints, [r.doc_id for r in rows], 2)
    expected = sorted(str((r.doc_id, f"{p:016x}", g)) for r, p, g in zip(rows, prints, groups))
    got = sorted(str(tuple(r)) for r in simhash.report(messy).select(
        "doc_id", "fingerprint", "component_id").collect())
    assert got == expected


@pytest.mark.parametrize("wide_key", [1, 64])
def test_links_of_close_values(spark, monkeypatch, wide_key):
    monkeypatch.setattr(simhash, "WIDE_KEY", wide_key)
    draw = random.Random(wide_key)
    values = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains and tight families
        value = draw.choice(values)
        for _ in range(draw.randrange(4)):
            value ^= 1 << draw.randrange(64)
        values.append(value)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    pairs = simhash.links(nodes)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 for r in pairs.collect())
    found = {r.node: r.component for r in components(pairs, "test").collect()}
    assert [found.get(v, v) for v in signed] == brute_groups(values, signed, 2)


def test_golay_code_is_perfect():
    _, _, errors = simhash.golay()
    assert (errors >= 0).all() and len(set(errors.tolist())) == 2048
    assert max(bin(e).count("1") for e in errors.tolist()) == 3
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 500)
    one_bit = words ^ (1 << draw.integers(0, 23, 500))
    for x, y in zip(words, one_bit):
        near = {int(simhash.codeword_indices(np.array([x ^ e]))[0]) for e in [0, *(1 << i for i in range(23))]}
        assert int(simhash.codeword_indices(np.array([y]))[0]) in near and len(near) in (1, 6)


def _edited(words: list[str], draw: random.Random, share: float) -> str:
    return " ".join(f"new{draw.randrange(10**6)}" if draw.random() < share else w for w in words)


def test_near_copies_are_grouped_and_others_are_not(spark):
    draw = random.Random(3)
    rows, family = [], {}
    for f in range(40):
        words = [f"w{draw.randrange(3000)}" for _ in range(300)]
        for _ in range(3):
            family[len(rows)] = f
            rows.append((len(rows), _edited(words, draw, 0.003)))
    got = {r.doc_id: r.component_id for r in simhash.near_grouped(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(family[g] == family[i] for i, g in got.items())
    assert np.mean([got[i] == 3 * family[i] for i in got]) > 0.97


def _jaccard(a: str, b: str) -> float:
    x, y = ({tuple(t.split()[i:i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_are_those_of_jaccard_08(spark):
    """Pairs around the limit: exactly those at or above it are grouped."""
    draw = random.Random(8)
    rows, expected = [], []
    for _ in range(400):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([8, 60, 200]))]
        other = list(words)
        for _ in range(max(1, len(words) // 40 + draw.randrange(-1, 3))):
            other[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
        if len(words) == 8:
            other = words + ["more"]  # 4 of 5 shingles
        pair = [" ".join(words), " ".join(other)]
        expected.append(_jaccard(*pair) >= 0.8)
        rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
    got = {r.doc_id: r.component_id for r in simhash.near_grouped(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 100 < sum(expected) < 380
    assert [got[2 * k] == got[2 * k + 1] for k in range(400)] == expected


def test_crowded_groups_are_compared_in_blocks(spark, monkeypatch):
    """A group larger than a block: chains and strays, with no block above its bound."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "PIVOTS", 2)
    largest, compare = [], simhash._linked_sets

    def watched(cells, similarity):
        largest.append(max(r["count"] for r in cells.groupBy("cell").count().collect()))
        return compare(cells, similarity)

    monkeypatch.setattr(simhash, "_linked_sets", watched)
    draw = random.Random(9)
    texts = [[f"w{draw.randrange(10**6)}" for _ in range(120)]]
    for _ in range(119):
        words = list(draw.choice(texts))
        for _ in range(draw.randrange(1, 5)):
            words[draw.randrange(120)] = f"new{draw.randrange(10**6)}"
        texts.append(words)
    texts = [" ".join(w) for w in texts]
    root = list(range(120))
    for i in range(120):
        for j in range(i):
            if _jaccard(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r.doc_id: r.component_id for r in simhash.near_grouped(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(set(root)) > 5 and [got[i] for i in range(120)] == root
    assert len(largest) == 2 and max(largest) < 60


def test_tight_and_chained_runs_hang_together():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, (1, 8), dtype=np.uint64)
    steps = np.zeros((30, 8), np.uint64)
    for i in range(30):  # each differs from the one before in 60 bits, from the first in many
        steps[i] = steps[i - 1] if i else 0
        steps[i, i % 8] ^= np.uint64((1 << 60) - 1) >> np.uint64(i % 5)
    chain = (base ^ steps)[draw.permutation(30)]
    ints = [int.from_bytes(x.tobytes(), "little") for x in chain]
    label = simhash.near_forest(chain, 77)
    groups = brute_groups(ints, list(range(30)), 77)
    assert len({(a, b) for a, b in zip(label.tolist(), groups)}) == len(set(groups))


def test_one_document_of_each_group_stays(messy):
    kept = simhash.deduplicated(messy)
    assert kept.schema == messy.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({-5, 1, 3, 5, 7, 8, 9, 11, 12, 13, 15, 16, 2**62})
    # 2 copies 1 and 6 copies 5; 10 is a near copy of 9; 4, 14 and a text without id are empty like 3.
    assert ids.count(None) == 1


@pytest.mark.parametrize("common", [1000, 0])
def test_texts_decide_and_not_ids(spark, monkeypatch, common):
    """Unlike texts of one id stay, near copies without an id go, repeated rows are one."""
    monkeypatch.setattr(simhash, "COMMON", common)
    draw = random.Random(6)
    a, b, c = ([f"w{draw.randrange(10**6)}" for _ in range(200)] for _ in range(3))
    near = [*c[:100], "changed", *c[101:]]
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (1, b, "y"), (None, c, "x"), (None, near, "x"),
            (None, near, "y"), (2, a, "x"), (None, b, "x")]
    docs = spark.createDataFrame([(i, " ".join(t), o) for i, t, o in rows],
                                 "doc_id long, text string, other string")
    kept = [(r.doc_id, r.text) for r in simhash.deduplicated(docs).collect()]
    assert sorted(kept[k][1] for k in range(len(kept)) if kept[k][0] == 1) == sorted(map(" ".join, (a, b)))
    unnamed = [t for i, t in kept if i is None]
    assert len(kept) == 3 and len(unnamed) == 1 and unnamed[0] in (" ".join(c), " ".join(near))


def test_most_rows_may_be_copies(spark):
    """A text, with and without ids, that most rows hold; other columns clash in name."""
    rows = [(None if i % 2 else i, "the same words " * 9, i, i) for i in range(90)]
    rows += [(None, f"unlike text number {i} " * 5, 0, i) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copies int, print long")
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0"] + ["None"] * 8
    named = {r.doc_id: r.component_id for r in simhash.grouped(docs).collect() if r.doc_id is not None}
    assert set(named.values()) == {0}


def test_empty(no_docs):
    assert simhash.report(no_docs).collect() == []
    assert simhash.deduplicated(no_docs).collect() == []


def test_near_copies_link_by_fingerprints_too(spark):
    """Fingerprints within two bits link, whatever the sets of distinct shingles share."""
    draw = random.Random(17)

    def some(n):
        return " ".join(f"w{draw.randrange(5000)}" for _ in range(n))

    rows = []
    for family in range(6):
        line = some(15)
        for n in (60, 61, 90):  # one line over and over, with tails of its own
            rows.append(" ".join([line] * n) + " " + some(8 + n // 4))
        rows.append(some(40))
    rows += [rows[0], "", None, "one", "two"]
    prints = [brute_print(t, 5) for t in rows]
    sets = [set(simhash.shingle_set(t or "", simhash.Shingles()).tolist()) for t in rows]
    expected = brute_groups(prints, list(range(len(rows))), 2)
    apart = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and expected[i] == expected[j] and rows[i] != rows[j]]
    assert apart and all(len(sets[i] & sets[j]) < 0.8 * len(sets[i] | sets[j]) for i, j in apart)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_grouped(docs).collect()}
    assert got == dict(enumerate(expected))
