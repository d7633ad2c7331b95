"""Tags and relevance of an article, as Column expressions.

Most functions take ``hits``, the set of lexicon literals the text contains
(:func:`newsloom.functions.vocabulary.lexicon_hits`), and read the text itself
only where a literal is present that needs a confirming pattern.  Text and
hits should be materialised columns so that they are built once per row: see
:func:`newsloom.operators.enrichment.enrich`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import (DEFAULT_LEXICON, FINANCE_SECTION, FINANCE_TOPICS,
                       SECTION_OF_PILLAR, SECTION_TIE_ORDER, TOPIC_BOOSTS,
                       Lexicon, Term)
from .binding import lit_array
from .vocabulary import choose, count_of, has_any


def search_text(title: Column, summary: Column, categories: Column) -> Column:
    """Searchable text of an article in its original case."""
    blank = F.lit(" ")
    return F.concat(blank, F.coalesce(title, F.lit("")),
                    blank, F.coalesce(summary, F.lit("")),
                    blank, F.coalesce(F.array_join(categories, " "), F.lit("")), blank)


def _alternation(patterns: Iterable[str]) -> str:
    """Ordered alternation, sorted into branches by first letter.

    Only patterns with the same first letter compete for a position, so their
    order is all that has to be kept.  Every pattern starts with a letter, a
    digit or a word boundary before one; the letters after a boundary are
    tried before the boundary itself, the costlier test.
    """
    by_first: dict[str, list[str]] = {}
    for p in patterns:
        start = re.match(r"(\\b)?([A-Za-z0-9]+)", p)
        literal = start[2]
        if re.match(r"[?*+]", p[start.end():]):  # the last one is optional
            literal = literal[:-1]
        guarded = f"(?={literal})(?:{p})" if start[1] else f"(?:{p})"
        by_first.setdefault(literal[0], []).append(guarded)
    body = choose([(c, ps[0] if len(ps) == 1 else "(?:" + "|".join(ps) + ")")
                   for c, ps in sorted(by_first.items())])
    return f"(?U)(?=[{''.join(sorted(by_first))}])({body})"


def _one_pattern(terms: Iterable[Term]) -> str:
    return _alternation(t.pattern for t in terms)


def matches_any(text: Column, hits: Column, terms: Iterable[Term]) -> Column:
    """True if one of the terms matches the text with the given hits."""
    terms = tuple(terms)
    plain = [t.literal for t in terms if t.pattern is None]
    guarded = [t for t in terms if t.pattern is not None and not t.also]
    tests = [has_any(hits, plain)] if plain else []
    if guarded:
        tests.append(has_any(hits, [t.literal for t in guarded])
                     & text.rlike(_one_pattern(guarded)))
    for t in terms:
        if t.pattern is not None and t.also:
            tests.append(has_any(hits, [t.literal]) & has_any(hits, t.also)
                         & text.rlike(_one_pattern([t])))
    return reduce(or_, tests)


def _names_where(conditions: dict[str, Column]) -> Column:
    """Names whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def pillar_tags(hits: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Pillars with at least one keyword in the text, in lexicon order."""
    return _names_where({p: has_any(hits, kws) for p, kws in lexicon.pillars.items()})


def regulation_tags(text: Column, hits: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Names of the regulations mentioned, sorted by code point."""
    return _names_where({n: matches_any(text, hits, lexicon.regulations[n])
                         for n in sorted(lexicon.regulations)})


def topic_tags(hits: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Topics with at least one keyword in the text, sorted."""
    return _names_where({t: has_any(hits, lexicon.topics[t])
                         for t in sorted(lexicon.topics)})


def market_tags(text: Column, raw_text: Column, hits: Column, source_market: Column,
                lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Markets an article concerns, sorted; GLOBAL if there is no other sign."""
    found = _names_where({
        m: (F.coalesce(source_market == m, F.lit(False))
            | matches_any(text, hits, lexicon.market_words[m])
            | raw_text.rlike(_one_pattern(lexicon.market_acronyms[m])))
        for m in sorted(lexicon.market_words)})
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("GLOBAL")))


def _core_regex(lexicon: Lexicon) -> str:
    return _alternation(lexicon.core_patterns)


def core_hits(text: Column, hits: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Number of distinct strings the core patterns match in the text."""
    found = F.regexp_extract_all(text, F.lit(_core_regex(lexicon)), F.lit(1))
    return (F.when(has_any(hits, lexicon.core_guards), F.size(F.array_distinct(found)))
            .otherwise(F.lit(0)))


def core_in_title(title: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """True if a core pattern matches the headline."""
    return F.coalesce(F.lower(title).rlike(_core_regex(lexicon)), F.lit(False))


def relevance_points(core: Column, in_title: Column, pillars: Column,
                     regulations: Column, topics: Column, source_type: Column,
                     summary: Column) -> Column:
    """Relevance as whole points from 0 to 100.

    Whole points keep the sum exact; the score is points / 100.
    """
    def capped(n: Column, each: int, cap: int) -> Column:
        return F.least(n * each, F.lit(cap))

    total = (capped(core, 8, 35)
             + F.when(in_title, 20).otherwise(0)
             + capped(F.size(pillars), 7, 21)
             + capped(F.size(regulations), 12, 24)
             + capped(F.size(topics), 3, 12)
             + F.when((source_type == "regulator") & (F.size(regulations) > 0), 8).otherwise(0)
             - F.when(F.coalesce(summary, F.lit("")) == "", 5).otherwise(0))
    return F.greatest(F.least(total, F.lit(100)), F.lit(0))


def pillar_strength(hits: Column, topics: Column,
                    lexicon: Lexicon = DEFAULT_LEXICON) -> dict[str, Column]:
    """Keyword matches per pillar plus the boosts its topics give."""
    out = {}
    for pillar, keywords in lexicon.pillars.items():
        strength = count_of(hits, keywords)
        for topic, (target, extra) in TOPIC_BOOSTS.items():
            if target == pillar:
                has_topic = F.coalesce(F.array_contains(topics, topic), F.lit(False))
                strength = strength + F.when(has_topic, extra).otherwise(0)
        out[pillar] = strength
    return out


def finance_strength(hits: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """How many capital-markets terms the text uses."""
    return count_of(hits, lexicon.finance_terms)


def section_of(strengths: dict[str, Column], finance: Column, topics: Column) -> Column:
    """The one report section an article belongs to."""
    strongest = F.greatest(*strengths.values())
    money = F.coalesce(
        F.arrays_overlap(topics, lit_array(FINANCE_TOPICS)), F.lit(False))
    out = F.when(money & (finance >= 2) & (finance >= strongest), F.lit(FINANCE_SECTION))
    for pillar in SECTION_TIE_ORDER:
        out = out.when(strengths[pillar] == strongest, F.lit(SECTION_OF_PILLAR[pillar]))
    return out
