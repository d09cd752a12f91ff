"""Column-level text helpers (all JVM-side, codegen friendly).

Semantics follow Python's ``str`` rules that the corpus tools rely on:
whitespace is the Unicode whitespace set of ``str.isspace`` (29 code points),
alphanumeric is Unicode category L or N, CJK is U+4E00..U+9FFF only.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex class equal to Python's Unicode whitespace: (?U)\s misses U+001C..U+001F.
WS = "[\\s\\x1c-\\x1f]"
_WS_RUN = "(?U)" + WS + "+"
_WS_ENDS = "(?U)^" + WS + "+|" + WS + "+$"
CJK_CLASS = "[一-鿿]"
ALNUM_CLASS = "[\\p{L}\\p{N}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (lambdas re-evaluate outer expressions, and filters pushed below a projection its columns)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def norm_ws(c) -> Column:
    """Collapse every whitespace run to one space and strip both ends."""
    return F.trim(F.regexp_replace(_c(c), _WS_RUN, " "))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace only."""
    return F.regexp_replace(_c(c), _WS_ENDS, "")


def has_cjk(c) -> Column:
    return _c(c).rlike(CJK_CLASS)


def is_punct_only(c) -> Column:
    """True when the stripped text has no letter or digit (blank counts as true)."""
    return ~F.coalesce(_c(c), F.lit("")).rlike(ALNUM_CLASS)


def words(c) -> Column:
    """Python ``str.split()``: whitespace-separated words, no empty strings."""
    return F.filter(F.split(norm_ws(c), " "), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c))


def cut(c, n: int) -> Column:
    """Prefix of ``n`` code points (for sample display)."""
    return F.substring(_c(c), 1, n)
