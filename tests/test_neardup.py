"""Near duplicates against a plain scan in rank order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions.text import token_signature
from newsloom.operators import neardup, ranking

A = ("Lakeside cooperative orders forty electric buses from Norrby works for the valley lines",
     "The cooperative signed for forty electric buses, and the Norrby works will deliver them to the valley.")
B = ("Norrby works to deliver electric buses to lakeside cooperative",
     "Forty electric buses were ordered by the cooperative for its valley lines.")
C = ("Glass recycling plant doubles its furnace capacity",
     "A second furnace melts bottles from three counties.")
D = ("Valley school wins a prize for its rooftop garden",
     "Pupils grow herbs and keep bees above the gym.")


def table(spark, rows):
    """(title, summary) pairs, best first."""
    data = [(f"{i:032x}", i, t, s) for i, (t, s) in enumerate(rows)]
    return spark.createDataFrame(data, "article_id string, r bigint, title string, summary string")


def scan(df, threshold=neardup.THRESHOLD):
    """Leader of every row by the plain sequential rule."""
    rows = df.select("article_id", token_signature(F.col("title"), F.col("summary")).alias("t"), "r").collect()
    kept, leaders = [], {}
    for row in sorted(rows, key=lambda r: (r.r, r.article_id)):
        mine = set(row.t)
        near = (k for k, other in kept if mine and other
                and len(mine & other) / min(len(mine), len(other)) >= threshold)
        leaders[row.article_id] = next(near, None)
        if leaders[row.article_id] is None:
            kept.append((row.article_id, mine))
    return leaders


def links(df, **options):
    return {r.id: r.leader for r in neardup.near_duplicate_links(df, "r", **options).orderBy("id").collect()}


def test_examples(spark):
    got = links(table(spark, [A, B, C, D]))
    assert list(got.values()).count(None) == 3
    assert got[f"{1:032x}"] == f"{0:032x}"


def random_stories(seed, n, words, hot=0.0):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rnd.random()
        if out and kind < 0.15:
            out.append(rnd.choice(out))
        elif kind < 0.2:
            out.append((" ".join(rnd.choice(["of", "at", "news1", "news2"]) for _ in range(rnd.randint(0, 2))), None))
        else:
            base = ["alpha", "beta", "gamma"] * (rnd.random() < hot)
            picks = [f"word{int(rnd.paretovariate(0.7)) % words}x" for _ in range(rnd.randint(1, 14))]
            out.append((" ".join(base + picks), rnd.choice([None, "tail end"])))
    return out


@pytest.mark.parametrize("seed,tuning", [
    (1, neardup.Tuning()),
    (2, neardup.Tuning(frequent=3, first_batch=25, growth=3)),
    (3, neardup.Tuning(frequent=3, first_batch=1, growth=200)),
    (4, neardup.Tuning(frequent=1, first_batch=110)),
])
def test_equals_sequential_scan(spark, seed, tuning):
    df = table(spark, random_stories(seed, 110, 50, hot=0.3))
    assert links(df, tuning=tuning) == scan(df)


def test_chain_keeps_both_ends(spark):
    # A~B, B~C, A unlike C
    rows = [("aaa1 bbb1 ccc1 ddd1", ""), ("aaa1 bbb1 eee1 fff1", ""), ("eee1 fff1 ggg1 hhh1", "")]
    assert list(links(table(spark, rows)).values()) == [None, f"{0:032x}", None]


def test_empty_signatures_are_kept(spark):
    assert set(links(table(spark, [("a of", None), ("a of", None), ("", "")])).values()) == {None}


def test_threshold_is_inclusive(spark):
    eight = " ".join(f"tok{c}x" for c in "abcdefgh")
    other = " ".join(f"tok{c}x" for c in "abcqrstuv")
    assert list(links(table(spark, [(eight, ""), (other, "")])).values()) == [None, f"{0:032x}"]


def distinct(df, n, **tuning):
    """Kept ids of every ranking in order."""
    got = neardup.first_distinct(df, "report", "r", n, tuning=neardup.Tuning(**tuning))
    out = {}
    for r in got.join(df.select("article_id", "r", F.col("report").alias("of")), "article_id").where(
            "report <=> of").orderBy("r", "article_id").collect():
        out.setdefault(r.report, []).append(r.article_id)
    return out


@pytest.mark.parametrize("block", [256, 7, 1])
def test_first_distinct_of_every_ranking(spark, block):
    df = table(spark, random_stories(9, 160, 40, hot=0.4)).withColumn(
        "report", F.when(F.col("r") % 5 > 0, (F.col("r") % 3).cast("string")))
    expected = {}
    for report in ("0", "1", "2", None):
        kept = [k for k, v in scan(df.where(F.col("report").eqNullSafe(report))).items() if v is None]
        expected[report] = kept[:6]
    assert distinct(df, 6, block=block) == expected


def test_ranking_of_one_family_ends_in_two_rounds(spark, monkeypatch):
    """All but a few of 600 stories tell the same: they go before the next block."""
    rows = [(f"alpha beta gamma delta own{i}x", "") for i in range(600)] + [C, D]
    df = table(spark, rows).withColumn("report", F.lit("all"))
    made = []
    real = neardup.cut_lineage
    monkeypatch.setattr(neardup, "cut_lineage", lambda d, name: made.append(name) or real(d, name))
    assert distinct(df, 3, block=16) == {"all": [f"{i:032x}" for i in (0, 600, 601)]}
    assert made.count("first-distinct") == 2


def test_first_distinct_of_nothing(spark):
    assert distinct(table(spark, [A]).where("r > 5").withColumn("report", F.lit("x")), 3) == {}


def candidates(df, tuning=neardup.Tuning()):
    """Key matches of the first batch and of its leaders with the rest."""
    folded = neardup._fold_copies(neardup.signatures(df, "r"))
    rows = neardup._prepare(folded, neardup.THRESHOLD, tuning).cache()
    first = rows.where(F.col("rank") < tuning.first_batch)
    small, large = neardup._keys(first, True), neardup._keys(rows, False)
    return small.groupBy("key").count().join(large.groupBy("key").agg(F.count("*").alias("n")), "key").agg(
        F.coalesce(F.sum(F.col("count") * F.col("n")), F.lit(0))).first()[0]


def test_one_short_story_changes_no_other_candidates(spark):
    rows = [(f"common1 common2 own{i}a own{i}b own{i}c own{i}d", "") for i in range(300)]
    tuning = neardup.Tuning(frequent=20, first_batch=400)
    before = candidates(table(spark, rows), tuning)
    assert candidates(table(spark, [*rows, ("solitary", "")]), tuning) <= before + 1


def test_family_is_scanned_once(spark, monkeypatch):
    """1000 near copies with signatures and equal ranks: no pair is listed, and
    each is compared with the one that is kept."""
    rows = [(f"{i:032x}", 0, f"alpha beta gamma delta epsilon own{i}x", "") for i in range(1000)]
    df = spark.createDataFrame(rows, "article_id string, r bigint, title string, summary string")
    monkeypatch.setattr(neardup, "_pairs_within", None)
    got = neardup.near_duplicate_links(df, "r")
    assert [r.id for r in got.where("leader IS NULL").collect()] == [f"{0:032x}"]
    kept = neardup._Kept(neardup.THRESHOLD)
    kept.add(["alpha", "beta", "own0"])
    assert sum(map(len, kept.holders.values())) == 3
    assert kept.first_near(["alpha", "beta", "own1"]) == 0 and kept.first_near([]) is None


def test_select_top_backfills(spark):
    rows = [(f"{i:032x}", t, s, 0.9 - i / 10, ["EU"], "2026-08-13") for i, (t, s) in enumerate([A, B, C, D])]
    df = spark.createDataFrame(rows, "article_id string, title string, summary string, relevance_score double, "
                                     "markets array<string>, d string").withColumn("published_date", F.to_date("d"))
    assert [r.title for r in ranking.select_top(df, 3).collect()] == [A[0], C[0], D[0]]
    assert ranking.select_top(df, 3, collapse=False).count() == 3
    assert ranking.select_top(df, 3, markets=["us"]).count() == 0


def test_keys_are_never_broadcast(spark):
    """A small stored table has many keys, which would all be held by the driver."""
    sigs = neardup.signatures(table(spark, random_stories(9, 60, 30)), "r")
    stored = neardup.cut_lineage(neardup._prepare(sigs, neardup.THRESHOLD, neardup.Tuning(frequent=1)), "few")
    for pairs in (neardup._pairs_within(stored, neardup.THRESHOLD),
                  neardup._first_leader(stored.where("rank < 20"), stored.where("rank >= 20"), neardup.THRESHOLD)):
        plan = pairs._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("seed,tuning", [
    (5, neardup.Tuning(first_batch=5, growth=2, batch=30, task=8, block=4)),
    (6, neardup.Tuning(first_batch=2, growth=100, held=40, task=30, block=3)),
])
def test_bounded_batches_equal_the_scan(spark, seed, tuning):
    """Batches and indexes that are full at once change nothing."""
    df = table(spark, random_stories(seed, 130, 60, hot=0.2))
    assert links(df, tuning=tuning) == scan(df)


def test_late_family_lists_no_pairs(spark, monkeypatch):
    """300 near copies that first appear after the first batch: no stored table has
    more rows than there are tokens, where their pairs would be 44,850."""
    rows = [(f"own{i}a own{i}b own{i}c own{i}d", "") for i in range(30)]
    rows += [(f"alpha beta gamma delta fam{i}x", "") for i in range(300)]
    stored = []
    real = neardup.cut_lineage
    monkeypatch.setattr(neardup, "cut_lineage", lambda d, name: stored.append(real(d, name)) or stored[-1])
    df = table(spark, rows)
    assert links(df, tuning=neardup.Tuning(first_batch=25, growth=20)) == scan(df)
    assert max(d.count() for d in stored) <= 5 * len(rows)


def test_open_stories_are_not_shuffled_by_key(spark, monkeypatch):
    """A round deals every open story out once, however many tokens it has: 60
    frequent ones made 1770 keys of a story before."""
    words = [f"word{i}x" for i in range(60)]
    rows = [(" ".join([f"own{i}{c}" for c in "abc"]), "") for i in range(30)]
    rows += [(" ".join([*random.Random(i).sample(words, 12), *(f"mine{i}n{k}x" for k in range(40))]), "")
             for i in range(60)]
    moved = []
    real = neardup.cut_lineage
    monkeypatch.setattr(neardup, "cut_lineage", lambda d, name: moved.append(
        (name, d._jdf.queryExecution().sparkPlan().toString())) or real(d, name))
    df = table(spark, rows)
    assert links(df, tuning=neardup.Tuning(frequent=2, first_batch=20, growth=2)) == scan(df)
    rounds = [plan for name, plan in moved if name in ("near-leaders", "decided", "pairs")]
    assert len(rounds) > 2 and not any("Generate explode" in plan for plan in rounds)


@pytest.mark.parametrize("threshold", [0.375, 0.3, 0.1, 0.7, 1.0, 1 / 3])
def test_fewest_shared_tokens(threshold):
    sizes = neardup.np.arange(1, 400)
    assert neardup._enough(sizes, threshold).tolist() == [
        next(n for n in range(1, size + 1) if n / size >= threshold) for size in sizes.tolist()]


def test_leaders_are_pairs_of_the_joins(spark):
    """Every retelling and its leader is a pair that the joins on keys find too."""
    df = table(spark, random_stories(12, 120, 50, hot=0.2))
    folded = neardup._prepare(neardup._fold_copies(neardup.signatures(df, "r")), neardup.THRESHOLD,
                              neardup.Tuning(frequent=3))
    pairs = {(r.late.id, r.early.id) for r in neardup._pairs_within(folded, neardup.THRESHOLD).collect()}
    first = {r.first for r in neardup._members(neardup.signatures(df, "r")).select(
        F.col("first_id").alias("first")).collect()}
    got = {k: v for k, v in links(df, tuning=neardup.Tuning(first_batch=10, growth=3)).items() if k in first}
    assert {(k, v) for k, v in got.items() if v} <= pairs


def test_collapse_keeps_the_first_of_a_late_family(spark, monkeypatch):
    """Batches are not resolved by pairs, however late a family appears."""
    rows = [(f"own{i}a own{i}b own{i}c own{i}d", "") for i in range(30)]
    rows += [(f"alpha beta gamma delta fam{i}x", "") for i in range(100)] + [C, D]
    monkeypatch.setattr(neardup, "_pairs_within", None)
    kept = neardup.collapse_near_duplicates(table(spark, rows), "r",
                                            tuning=neardup.Tuning(first_batch=25, growth=3))
    assert {r.article_id for r in kept.collect()} == {f"{i:032x}" for i in [*range(31), 130, 131]}
