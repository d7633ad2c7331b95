"""Name an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain Python variable would paste the whole expression wherever it is
    used, and a few nested uses already outgrow what Spark can compile.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def groups(text: Column, pattern: str, count: int) -> Column:
    """Capture groups 1..count of a pattern that spans the whole text, as an
    array; NULL if the text does not match.  One pass of the expression."""
    mark = "\x01"
    refs = mark.join(f"${i}" for i in range(1, count + 1))
    return F.when(text.rlike(pattern),
                  F.split(F.regexp_replace(text, pattern, refs), mark))


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lit_array(values: Iterable[str]) -> Column:
    """Constant array of strings, parsed in one go: much cheaper to build than
    one literal column per value."""
    items = ", ".join(sql_text(v) for v in values)
    return F.expr(f"array({items})" if items else "cast(array() as array<string>)")
