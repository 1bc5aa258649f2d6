"""NULL semantics of the source scripts, re-expressed with built-in Spark expressions.

The source language treats a missing value in a regex test as *no match*
(so a negated test keeps the row), turns NULL into the text ``"NA"`` when
pasting, and makes ``min``/``max``/``sum`` return NULL when any input is
missing.  Each rule is one helper so every query applies it the same way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def matches(col, pattern: str, ignore_case: bool = True) -> Column:
    """Regex search that is FALSE (never NULL) on a NULL input."""
    pat = f"(?i){pattern}" if ignore_case else pattern
    return F.coalesce(_c(col).rlike(pat), F.lit(False))


def any_matches(cols_patterns: Iterable[tuple], ignore_case: bool = True) -> Column:
    """OR of several ``matches`` over (column, pattern) pairs."""
    out = None
    for col, pat in cols_patterns:
        m = matches(col, pat, ignore_case)
        out = m if out is None else (out | m)
    return out if out is not None else F.lit(False)


def not_matches(col, pattern: str, ignore_case: bool = True) -> Column:
    """Row filter for 'drop rows that match', keeping NULL rows."""
    return ~matches(col, pattern, ignore_case)


def not_in_keep_null(col, values: Iterable) -> Column:
    """``!(x %in% values)``: NULL is kept."""
    c = _c(col)
    return c.isNull() | ~c.isin(list(values))


def paste(*parts, na: str = "NA") -> Column:
    """Concatenate like the source ``paste0``: a NULL part prints as ``NA``.

    Python strings are literals; pass ``F.col(name)`` for columns.
    """
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit(na)) for c in cols])


def eq_or_false(col, value) -> Column:
    """``col == value`` where NULL counts as not equal (CASE WHEN semantics)."""
    return F.coalesce(_c(col) == value, F.lit(False))


def strict_min(col) -> Column:
    """``min`` that is NULL when any input of the group is NULL."""
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.min(c))


def strict_max(col) -> Column:
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.max(c))


def strict_sum(col) -> Column:
    c = _c(col)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def null_safe_on(left, right, pairs: Iterable[tuple[str, str]]) -> Column:
    """Join condition that matches NULL to NULL (the source's default join rule)."""
    cond = None
    for lk, rk in pairs:
        e = left[lk].eqNullSafe(right[rk])
        cond = e if cond is None else cond & e
    return cond
