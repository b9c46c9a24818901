"""Text predicates: the LIKE forms the reference uses."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def contains_ci(col: Column | str, term: str) -> Column:
    """``LOWER(col) LIKE '%term%'`` with the term lowered too."""
    return F.lower(_c(col)).contains(term.lower())


def contains_any_ci(col: Column | str, terms: Iterable[str]) -> Column:
    terms = list(terms)
    if not terms:
        return F.lit(False)
    low = F.lower(_c(col))
    return reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in terms])


def like_any(col: Column | str, patterns: Iterable[str]) -> Column:
    """Case-sensitive ``col LIKE p1 OR col LIKE p2 ...`` (``.`` is literal)."""
    patterns = list(patterns)
    if not patterns:
        return F.lit(False)
    c = _c(col)
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])
