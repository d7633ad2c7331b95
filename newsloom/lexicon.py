"""Vocabulary used for tagging, scoring, routing and glossary work.

A :class:`Lexicon` is an immutable parameter of the enrichment functions; pass
another instance to curate a different subject area.  All vocabulary except
the acronyms is matched on lower-cased text.

Every entry is a :class:`Term`: a literal that must occur in the text and,
where a bare substring is too loose, a regular expression that must match as
well.  The literal is a cheap guard (a byte scan), so the expression only runs
on the few texts that can possibly match it.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Term:
    """A literal guard plus an optional confirming pattern.

    ``also`` lists literals of which at least one must occur too (an unordered
    "both somewhere in the text" condition).
    """

    literal: str
    pattern: str | None = None
    also: tuple[str, ...] = ()


def phrase(text: str) -> Term:
    """Substring match."""
    return Term(text)


def word(text: str) -> Term:
    """Whole-word match."""
    return Term(text, rf"\b{text}\b")


def stem_end(text: str) -> Term:
    """Match that has to end at a word boundary but may start inside a word."""
    return Term(text, rf"{text}\b")


def _phrases(*texts: str) -> tuple[Term, ...]:
    return tuple(phrase(t) for t in texts)


# ---------------------------------------------------------------------------
# Theme vocabulary (substring match).
# ---------------------------------------------------------------------------
PILLARS: dict[str, tuple[str, ...]] = {
    "E": (
        "climate", "emission", "carbon", "net zero", "net-zero", "decarboni",
        "greenhouse gas", "ghg", "scope 1", "scope 2", "scope 3", "renewable",
        "solar", "wind power", "offshore wind", "biodiversity",
        "deforestation", "circular economy", "waste", "recycling",
        "water stress", "pollution", "air quality", "energy transition",
        "clean energy", "fossil fuel", "coal", "methane", "nature-based",
        "sustainable aviation fuel", "electric vehicle", "battery",
        "hydrogen", "carbon capture", "climate risk", "physical risk",
        "transition risk", "adaptation", "environmental impact",
        "green bond", "carbon credit", "carbon market", "offset",
        "science-based target", "sbti",
    ),
    "S": (
        "human rights", "labour", "labor rights", "forced labour",
        "forced labor", "child labour", "child labor", "modern slavery",
        "supply chain due diligence", "diversity", "inclusion", "dei",
        "gender pay", "pay gap", "workforce", "health and safety",
        "worker safety", "community impact", "indigenous",
        "just transition", "living wage", "employee wellbeing",
        "social impact", "affordable housing", "data privacy",
        "product safety", "responsible sourcing", "conflict minerals",
    ),
    "G": (
        "governance", "board", "executive pay", "executive compensation",
        "say on pay", "shareholder", "proxy", "proxy voting", "activist",
        "disclosure", "reporting standard", "assurance", "audit",
        "anti-corruption", "bribery", "whistleblower", "greenwashing",
        "fiduciary", "stewardship", "materiality", "double materiality",
        "compliance", "enforcement", "fine", "lawsuit", "litigation",
        "sanction", "transparency", "esg rating", "ratings agency",
    ),
}

# ---------------------------------------------------------------------------
# Regulations and frameworks.
# ---------------------------------------------------------------------------
OMNIBUS_CONTEXT = ("csrd", "csddd", "sfdr", "esrs", "taxonomy", "sustainab")

REGULATIONS: dict[str, tuple[Term, ...]] = {
    "CSRD": (word("csrd"), phrase("corporate sustainability reporting directive")),
    "CSDDD": (word("csddd"), word("cs3d"), phrase("corporate sustainability due diligence")),
    "SFDR": (word("sfdr"), phrase("sustainable finance disclosure regulation")),
    "EU_Taxonomy": _phrases("eu taxonomy", "taxonomy regulation"),
    "ESRS": (word("esrs"), phrase("european sustainability reporting standards")),
    "CBAM": (word("cbam"), phrase("carbon border adjustment")),
    "EUDR": (word("eudr"), phrase("deforestation regulation")),
    "EU_ETS": (word("eu ets"), phrase("emissions trading system")),
    "Green_Claims_Directive": _phrases("green claims directive", "empowering consumers directive"),
    # The bare word also names an unrelated spending bill, so it counts only
    # next to one of the context words, wherever that stands in the text.
    "Omnibus": _phrases(
        "omnibus package", "omnibus proposal", "omnibus simplification",
        "omnibus directive", "omnibus regulation", "simplification omnibus",
        "sustainability omnibus",
    ) + (Term("omnibus", r"\bomnibus\b", OMNIBUS_CONTEXT),),
    "SEC_Climate_Rule": (
        Term("sec climate", r"sec climate(?:[- ]related)? (?:disclosure )?rule"),
        phrase("climate disclosure rule"),
    ),
    "California_SB253": (
        Term("253", r"\bsb[- ]?253\b"),
        phrase("climate corporate data accountability"),
    ),
    "California_SB261": (Term("261", r"\bsb[- ]?261\b"),),
    "IRA": (stem_end("inflation reduction act"),),
    "ISSB": (word("issb"),) + _phrases(
        "ifrs s1", "ifrs s2", "international sustainability standards board",
    ),
    "TCFD": (word("tcfd"), phrase("task force on climate")),
    "TNFD": (word("tnfd"), phrase("taskforce on nature")),
    "GRI": (
        Term("gri standard", r"\bgri standards?\b"),
        phrase("global reporting initiative"),
    ),
    "Paris_Agreement": _phrases("paris agreement"),
    "UK_SDR": (word("sdr"), phrase("sustainability disclosure requirements")),
}

# ---------------------------------------------------------------------------
# Topics (substring match).
# ---------------------------------------------------------------------------
TOPICS: dict[str, tuple[str, ...]] = {
    "regulation_policy": (
        "regulation", "directive", "rule", "legislation", "parliament",
        "council", "policy", "mandate", "guidance", "consultation",
        "framework", "law", "bill", "act",
    ),
    "reporting_disclosure": (
        "disclosure", "reporting", "report", "assurance", "audit",
        "materiality", "taxonomy", "kpi", "metrics",
    ),
    "sustainable_finance": (
        "green bond", "sustainability-linked", "esg fund",
        "impact investing", "transition finance", "blended finance",
        "asset manager", "divest", "sustainable finance", "climate finance",
        "aum",
    ),
    "carbon_markets": (
        "carbon credit", "carbon market", "offset", "carbon price",
        "emissions trading", "article 6", "removal credit",
    ),
    "energy_transition": (
        "renewable", "solar", "wind", "hydrogen", "grid", "battery storage",
        "nuclear", "power purchase agreement", "ppa", "electrification",
    ),
    "corporate_action": (
        "announced", "launches", "acquires", "partnership", "invests",
        "commits", "pledge", "target", "appoints",
    ),
    "litigation_enforcement": (
        "lawsuit", "sues", "court", "ruling", "fine", "penalty",
        "enforcement", "settlement", "investigation", "charges",
    ),
    "greenwashing": (
        "greenwash", "misleading claim", "false advertising",
        "unsubstantiated claim",
    ),
    "supply_chain": (
        "supply chain", "supplier", "due diligence", "traceability",
        "sourcing", "procurement",
    ),
}

# ---------------------------------------------------------------------------
# Market signals.  Words match lower-cased text; acronyms match
# the original case, because "US" and "us" mean different things.
# ---------------------------------------------------------------------------
EU_WORDS: tuple[Term, ...] = (
    *_phrases("european union", "brussels", "european commission",
              "european parliament", "european council",
              "european central bank", "eurozone", "germany"),
    stem_end("german"), phrase("france"), stem_end("french"),
    phrase("spain"), stem_end("spanish"), phrase("italy"),
    stem_end("italian"), phrase("netherlands"), stem_end("dutch"),
    phrase("poland"), stem_end("polish"), phrase("sweden"),
    stem_end("swedish"), phrase("denmark"), stem_end("danish"),
    phrase("belgium"), phrase("ireland"), stem_end("irish"),
    *_phrases("austria", "portugal", "finland", "greece", "czech",
              "eu taxonomy"),
)
EU_ACRONYMS: tuple[Term, ...] = tuple(
    word(a) for a in ("EU", "EBA", "ESMA", "EIOPA", "ECB", "CSRD", "SFDR",
                      "ESRS", "CBAM", "EUDR", "CSDDD")
)
US_WORDS: tuple[Term, ...] = (
    phrase("united states"), stem_end("american"),
    *_phrases("washington", "congress", "senate", "white house",
              "california", "texas", "new york", "biden", "trump",
              "federal reserve", "inflation reduction act",
              "state department", "supreme court", "department of energy",
              "environmental protection agency",
              "securities and exchange commission"),
)
US_ACRONYMS: tuple[Term, ...] = (
    Term("U.S.", r"\bU\.S\."),
    *(word(a) for a in ("US", "USA", "SEC", "EPA", "FERC", "CFTC", "FHFA",
                        "DOE", "IRS", "NOAA")),
    Term("253", r"\bSB[- ]?253\b"),
    Term("261", r"\bSB[- ]?261\b"),
)

# ---------------------------------------------------------------------------
# Core relevance patterns.  One ordered alternation; earlier
# alternatives win, matches do not overlap.
# ---------------------------------------------------------------------------
CORE_PATTERNS: tuple[str, ...] = (
    r"\besg\b",
    r"sustainab",
    r"\bclimate\b",
    r"\bcarbon\b",
    r"\bemissions?\b",
    r"net[-\s]zero",
    r"\bgreen\b(?!\s+light)",
    r"\brenewables?\b",
    r"decarboni",
    r"\benvironmental\b",
    r"\bgovernance\b",
    r"\bbiodiversity\b",
    r"circular economy",
    r"\bfossil fuels?\b",
    r"energy transition",
    r"just transition",
    r"climate transition",
    r"low[-\s]carbon transition",
    r"green transition",
    r"net[-\s]zero transition",
    r"transition (?:plan|finance|risk|pathway)",
)
# A text without any of these literals cannot match a core pattern.
CORE_GUARDS: tuple[str, ...] = (
    "esg", "sustainab", "climate", "carbon", "emission", "green",
    "renewable", "decarboni", "environmental", "governance", "biodiversity",
    "circular economy", "fossil fuel", "transition",
    # A hyphen or any white space; "net" alone would let most texts pass.
    *(f"net{c}zero" for c in "-\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"),
)

# ---------------------------------------------------------------------------
# Section routing.
# ---------------------------------------------------------------------------
FINANCE_TERMS: tuple[str, ...] = (
    "fund", "investor", "investment", "financing", "finance", "capital",
    "bond", "raised", "raises", "billion", "million", "portfolio", "divest",
    "issuance", "asset manager", "aum", "shareholder", "credit", "loan",
    "underwriting", "insurer", "valuation", "carbon price", "carbon market",
    "offset", "stake", "acquisition", "ipo", "equity", "debt",
)
FINANCE_TOPICS: tuple[str, ...] = ("sustainable_finance", "carbon_markets")
FINANCE_SECTION = "Sustainable Finance"
# Topic -> (pillar, extra strength).
TOPIC_BOOSTS: dict[str, tuple[str, int]] = {
    "reporting_disclosure": ("G", 2),
    "litigation_enforcement": ("G", 2),
    "greenwashing": ("G", 2),
    "supply_chain": ("S", 2),
}
# Sections in report order; a tie in strength goes to the pillar that stands
# first in SECTION_TIE_ORDER.
SECTION_ORDER: tuple[str, ...] = ("Environment", "Social", "Governance", FINANCE_SECTION)
SECTION_OF_PILLAR: dict[str, str] = {"E": "Environment", "S": "Social", "G": "Governance"}
SECTION_TIE_ORDER: tuple[str, ...] = ("E", "G", "S")

# ---------------------------------------------------------------------------
# Headline signatures and glossary terms.
# ---------------------------------------------------------------------------
STOPWORDS: tuple[str, ...] = (
    "the", "a", "an", "and", "or", "but", "for", "to", "of", "in", "on",
    "at", "by", "with", "from", "as", "is", "are", "was", "were", "be",
    "been", "its", "it", "this", "that", "these", "those", "new", "over",
    "more", "after", "into", "amid", "says", "said", "will", "has", "have",
    "not",
)
GLOSSARY_SKIP: tuple[str, ...] = (
    "ESG", "EU", "US", "USA", "UK", "UN", "CEO", "CFO", "COO", "CIO", "IT",
    "AI", "GDP", "PLC", "INC", "LTD", "LLC", "AGM", "Q1", "Q2", "Q3", "Q4",
    "USD", "EUR", "GBP", "TV", "PDF", "FAQ", "RFP", "NGO", "SA", "H2",
    "UTC", "GMT", "MW", "GW", "KW", "TWH", "CO2", "AM", "PM",
)
GLOSSARY_PHRASES: tuple[str, ...] = (
    "double materiality", "financed emissions", "transition finance",
    "transition plan", "physical risk", "transition risk",
    "just transition", "carbon credit", "carbon offset", "carbon intensity",
    "green bond", "sustainability-linked", "green hydrogen",
    "green ammonia", "carbon removal", "carbon capture", "net-zero",
    "science-based target", "taxonomy", "stewardship", "greenwashing",
    "circular economy",
)


@dataclass(frozen=True)
class Lexicon:
    """All vocabulary one curation run depends on."""

    pillars: dict[str, tuple[str, ...]] = field(default_factory=lambda: PILLARS)
    regulations: dict[str, tuple[Term, ...]] = field(default_factory=lambda: REGULATIONS)
    topics: dict[str, tuple[str, ...]] = field(default_factory=lambda: TOPICS)
    market_words: dict[str, tuple[Term, ...]] = field(
        default_factory=lambda: {"EU": EU_WORDS, "US": US_WORDS})
    market_acronyms: dict[str, tuple[Term, ...]] = field(
        default_factory=lambda: {"EU": EU_ACRONYMS, "US": US_ACRONYMS})
    core_patterns: tuple[str, ...] = CORE_PATTERNS
    core_guards: tuple[str, ...] = CORE_GUARDS
    finance_terms: tuple[str, ...] = FINANCE_TERMS
    stopwords: tuple[str, ...] = STOPWORDS
    glossary_skip: tuple[str, ...] = GLOSSARY_SKIP
    glossary_phrases: tuple[str, ...] = GLOSSARY_PHRASES


DEFAULT_LEXICON = Lexicon()
