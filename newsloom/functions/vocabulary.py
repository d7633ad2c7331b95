"""Find which words of a vocabulary occur in a text, in one pass.

Asking ``contains`` for each of some three hundred literals reads the text
three hundred times, and a regular expression of all of them still tries some
branches at every position.  Here the first three bytes at every position are
looked up in one table, for a batch of texts at a time, and only where a literal
begins with them is it compared.  The result is the exact set of literals that
occur as substrings.  Texts travel in Arrow batches; callers keep the result as
a value (:func:`newsloom.operators.enrichment.materialize`).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import Lexicon
from .binding import lit_array


# Alternatives tried one by one before a character-class test splits them.
_FAN_OUT = 5


def choose(branches: list[tuple[str, str]]) -> str:
    """Regex for one of several (first character, rest) branches; long lists
    are split by look-aheads, so that few alternatives are tried in vain."""
    if len(branches) == 1:
        return branches[0][1]
    if len(branches) <= _FAN_OUT:
        return "(?:" + "|".join(rest for _, rest in branches) + ")"
    size = -(-len(branches) // _FAN_OUT)
    parts = [branches[i:i + size] for i in range(0, len(branches), size)]
    return "(?:" + "|".join(
        "(?=[" + "".join(re.escape(c) for c, _ in part) + "])" + choose(part)
        for part in parts) + ")"


#: Bytes of text that are looked at in one piece.
_PIECE = 1 << 20


@functools.lru_cache(maxsize=4)
def _beginnings(words: tuple[str, ...]) -> tuple[int, np.ndarray, dict[bytes, list[tuple[bytes, str]]]]:
    """Length of the beginnings (at most three bytes), which of them words have, and these words."""
    by_start: dict[bytes, list[tuple[bytes, str]]] = {}
    words = tuple(w for w in words if w)
    width = min([3, *(len(w.encode()) for w in words)])
    for w in words:
        by_start.setdefault(w.encode()[:width], []).append((w.encode(), w))
    known = np.zeros(1 << 8 * width, bool)
    for start in by_start:
        known[int.from_bytes(start, "big")] = True
    return width, known, by_start


def _found(texts: list[bytes], words: tuple[str, ...]) -> list[list[str]]:
    """The words that occur in each of the texts."""
    width, known, by_start = _beginnings(words)
    ends = np.cumsum([len(t) for t in texts])
    joined = b"".join(texts)
    out: list[set[str]] = [{w for w in words if not w} for _ in texts]
    n = len(joined) - width + 1
    if n > 0:
        raw = np.frombuffer(joined, np.uint8)
        code = raw[:n].astype(np.int32)
        for i in range(1, width):
            code = code << 8 | raw[i:n + i]
        at = np.flatnonzero(known[code])
        rows = np.searchsorted(ends, at, side="right")
        for place, row, end in zip(at.tolist(), rows.tolist(), ends[rows].tolist()):
            for word, name in by_start[joined[place:place + width]]:
                if joined.startswith(word, place, end):
                    out[row].add(name)
    return [sorted(names) for names in out]


def words_in(text: Column, words: Iterable[str]) -> Column:
    """Distinct words of the list that occur in the text as substrings, sorted;
    NULL for NULL."""
    vocabulary = tuple(sorted(set(words)))

    @F.pandas_udf("array<string>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out, held, size = [], [], 0
            for t in batch:
                held.append(t or b"")
                size += len(held[-1])
                if size >= _PIECE:
                    out += _found(held, vocabulary)
                    held, size = [], 0
            out += _found(held, vocabulary)
            yield pd.Series([None if t is None else names for t, names in zip(batch, out)],
                            dtype=object)

    return find(text.cast("binary"))


def _literals(lexicon: Lexicon) -> Iterable[str]:
    for group in (*lexicon.pillars.values(), *lexicon.topics.values(),
                  lexicon.finance_terms, lexicon.core_guards):
        yield from group
    for terms in (*lexicon.regulations.values(), *lexicon.market_words.values()):
        for t in terms:
            yield t.literal
            yield from t.also


def lexicon_hits(text: Column, lexicon: Lexicon) -> Column:
    """All literals of a lexicon (its acronyms aside) that a lower-cased text
    contains."""
    return words_in(text, _literals(lexicon))


def has_any(hits: Column, words: Iterable[str]) -> Column:
    """True if one of the words is among the hits."""
    return F.arrays_overlap(hits, lit_array(dict.fromkeys(words)))


def count_of(hits: Column, words: Iterable[str]) -> Column:
    """How many of the words are among the hits."""
    return F.size(F.array_intersect(hits, lit_array(dict.fromkeys(words))))
