"""Tags, markets, score and gate."""

from __future__ import annotations

import itertools

import pytest
from rows import article
from pyspark.sql import functions as F

from newsloom.functions import tagging
from newsloom.functions.vocabulary import lexicon_hits
from newsloom.lexicon import Lexicon
from newsloom.operators.enrichment import enrich, with_timestamps
from newsloom.operators.filters import is_relevant


def tagged(raw, **changes):
    return enrich(with_timestamps(raw([article(**changes)]))).first()


def test_pillars_and_regulations(raw):
    row = tagged(raw, title="EU adopts CSRD omnibus cutting reporting burden",
                 summary="Board governance and carbon emission disclosure rules.", source_type="regulator")
    assert row.esg_pillars == ["E", "G"]
    assert row.regulations == ["CSRD", "Omnibus"]
    assert "EU" in row.markets and row.is_eu and not row.is_us


def test_markets(raw):
    assert tagged(raw, title="Biodiversity study tells us more", summary="A doe in the forest.",
                  source_market="GLOBAL").markets == ["GLOBAL"]
    assert tagged(raw, title="European Commission and SEC diverge", source_market="GLOBAL",
                  summary="Brussels and Washington take different paths.").markets == ["EU", "US"]
    assert tagged(raw, title="The U.S. and SB 253", summary="", source_market="GLOBAL").markets == ["US"]
    assert tagged(raw, title="Germanium mine", summary="x", source_market="GLOBAL").markets == ["GLOBAL"]
    assert tagged(raw, title="polish and Germany", summary="", source_market="US").markets == ["EU", "US"]


@pytest.mark.parametrize("text,found", [
    ("omnibus spending bill", False), ("csrd then later the omnibus", True),
    ("omnibus " + "x " * 50 + "sustainability", True), ("omnibuses and csrd", False),
    ("an omnibus package", True),
])
def test_omnibus_needs_context(raw, text, found):
    assert ("Omnibus" in tagged(raw, title=text, summary="").regulations) is found


def test_word_boundaries_are_unicode(raw):
    assert tagged(raw, title="écsrd", summary="").regulations == []
    assert tagged(raw, title="a csrd b", summary="").regulations == ["CSRD"]


@pytest.mark.parametrize("title,summary,kept", [
    ("Signal box gets the green light", "Trains run through the night.", False),
    ("Greenland ferry keeps its summer timetable", "Boats leave twice a day.", False),
    ("Choir master hands over in a smooth transition", "A new voice leads the choir.", False),
    ("Bakery opens a third shop", "Queues formed before dawn.", False),
    ("Island grid sells a green bond for its energy transition", "Renewable turbines follow.", True),
    ("Pension board leaves a sustainable fund", "ESG ratings were cut twice.", True),
])
def test_gate_examples(raw, title, summary, kept):
    rows = enrich(with_timestamps(raw([article(title=title, summary=summary)])))
    assert (rows.filter(is_relevant()).count() == 1) is kept


def test_regulator_with_regulation_always_passes(raw):
    rows = enrich(with_timestamps(raw([article(
        title="Customs desk publishes CBAM forms", summary="", source_type="regulator")])))
    assert rows.filter(is_relevant()).count() == 1


def test_gate_boundaries(spark):
    rows = spark.createDataFrame([
        ("media", [], ["E"], 0.15, True), ("media", [], ["E"], 0.14, False),
        ("media", [], [], 0.30, True), ("media", [], [], 0.29, False),
        ("regulator", ["CSRD"], [], 0.0, True), ("regulator", [], [], 0.1, False),
    ], "source_type string, regulations array<string>, esg_pillars array<string>, relevance_score double, want boolean")
    assert all(r.got == r.want for r in rows.withColumn("got", is_relevant()).collect())


def test_core_hits_prefer_earlier_alternatives(raw):
    base = dict(summary=None, source_type="media")
    # climate (8) + title (20) + E (7) - no summary (5)
    assert tagged(raw, title="climate transition", **base).relevance_score == 0.30
    # "low-carbon transition" starts before "carbon", so it is one match
    assert tagged(raw, title="low-carbon transition", **base).relevance_score == 0.30
    assert tagged(raw, title="climate climate climate", **base).relevance_score == 0.30


def test_score_equals_float_formula(spark):
    grid = list(itertools.product(range(0, 7), (False, True), range(4), range(4), range(6), (False, True), (False, True)))
    df = spark.createDataFrame(grid, "c int, t boolean, p int, r int, o int, reg boolean, s boolean")
    tags = {n: F.array_repeat(F.lit("x"), F.col(n)) for n in "pro"}
    points = tagging.relevance_points(F.col("c"), F.col("t"), tags["p"], tags["r"], tags["o"],
                                      F.when(F.col("reg"), "regulator").otherwise("media"),
                                      F.when(F.col("s"), F.lit("text")))
    got = [r[0] for r in df.select((points.cast("double") / F.lit(100.0))).collect()]

    def expected(c, t, p, r, o, reg, s):
        score = min(c * 0.08, 0.35) + (0.2 if t else 0) + min(p * 0.07, 0.21) + min(r * 0.12, 0.24)
        score += min(o * 0.03, 0.12) + (0.08 if reg and r else 0) - (0 if s else 0.05)
        return round(max(0.0, min(score, 1.0)), 4)
    assert got == [expected(*g) for g in grid]


def test_publish_date_flag_and_keys(raw):
    dated, undated = tagged(raw), tagged(raw, published_at=None)
    assert dated.has_publish_date and not undated.has_publish_date
    assert tagged(raw, canonical_url="").dedupe_key == "harbour town drafts csrd carbon report"


def test_other_lexicon_and_scorer(raw):
    lexicon = Lexicon(pillars={"T": ("tulip",)}, topics={}, regulations={})
    row = enrich(with_timestamps(raw([article(title="Tulip prices")])), lexicon,
                 scorer=lambda f: F.size(f.esg_pillars).cast("double")).first()
    assert row.esg_pillars == ["T"] and row.topics == [] and row.relevance_score == 1.0


def test_core_patterns_pass_their_guards(spark):
    """Every white space in "net zero" is seen, and "net" alone does not read the text again."""
    texts = [f"a net{chr(c)}zero plan" for c in [*range(1, 0x100), *range(0x1680, 0x1681), *range(0x180e, 0x180f),
                                                *range(0x1ff0, 0x2070), 0x3000, 0xfeff]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    hits = lexicon_hits(F.col("t"), Lexicon())
    seen = rows.select(tagging.core_hits(F.col("t"), hits).alias("n"),
                       F.regexp_like("t", F.lit(r"(?U)net[-\s]zero")).alias("match"), "t").collect()
    assert [r.t for r in seen if (r.n > 0) != r.match] == []
    assert "net" not in Lexicon().core_guards
