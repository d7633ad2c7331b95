"""Text helpers: HTML stripping, keys, signatures, glossary terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import DEFAULT_LEXICON, Lexicon
from .binding import lit_array

# Every character that counts as white space in feed text, the four ASCII
# separators 0x1C-0x1F included.
SPACE = r"(?U)[\s\x1c-\x1f]+"


def collapse_space(text: Column) -> Column:
    """One blank per run of white space, none at the ends; empty becomes NULL."""
    return F.nullif(F.trim(F.regexp_replace(text, SPACE, " ")), F.lit(""))


def strip_html(text: Column) -> Column:
    """Plain text of an HTML fragment; empty becomes NULL.

    Entities are decoded once each, in the listed order, after the tags are
    gone, so a doubly escaped bracket stays a bracket and never becomes a tag.
    """
    out = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"),
                         ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse_space(out)


def title_key(title: Column) -> Column:
    """Lower-case ASCII words of a headline joined by blanks ('' for none)."""
    words = F.regexp_extract_all(F.lower(title), F.lit("[a-z0-9]+"), F.lit(0))
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def clean_labels(labels: Column, limit: int = 12) -> Column:
    """Trimmed, distinct, sorted category labels, at most ``limit`` of them."""
    trimmed = F.transform(
        F.filter(labels, lambda x: x.isNotNull() & (x != "")),
        lambda x: F.regexp_replace(x, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return F.slice(F.array_sort(F.array_distinct(trimmed)), 1, limit)


def token_signature(title: Column, summary: Column,
                    lexicon: Lexicon = DEFAULT_LEXICON,
                    opening: int = 200) -> Column:
    """Distinct significant words of a headline and the opening of its summary.

    The stop-word test comes before the plural ending is cut off.
    """
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "),
                            F.coalesce(F.substring(summary, 1, opening), F.lit(""))))
    words = F.regexp_extract_all(text, F.lit("[a-z0-9$]+"), F.lit(0))
    stop = lit_array(lexicon.stopwords)
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w))
    return F.array_distinct(F.transform(kept, lambda w: F.regexp_replace(w, "s+$", "")))


def extract_terms(text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """Acronyms, jargon phrases and emission scopes a text uses, sorted
    without regard to case."""
    skipped = lit_array(lexicon.glossary_skip)
    acronyms = F.filter(
        F.regexp_extract_all(text, F.lit(r"(?U)\b([A-Z]{2,6})\b"), F.lit(1)),
        lambda a: ~F.array_contains(skipped, a))
    low = F.lower(text)
    phrases = F.filter(lit_array(lexicon.glossary_phrases),
                       lambda p: F.contains(low, p))
    digits = F.array_sort(F.array_distinct(
        F.regexp_extract_all(text, F.lit(r"(?iU)\bscope\s*([123])\b"), F.lit(1))))
    scopes = F.when(
        F.size(digits) > 0,
        F.array(F.concat(F.lit("Scope "), F.array_join(digits, " and "),
                         F.lit(" emissions")))
    ).otherwise(F.array().cast("array<string>"))
    terms = F.array_distinct(F.concat(acronyms, phrases, scopes))
    ordered = F.array_sort(F.transform(
        terms, lambda t: F.struct(F.lower(t).alias("k"), t.alias("t"))))
    return F.transform(ordered, lambda s: s["t"])
