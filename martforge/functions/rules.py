"""Ordered label rules ("first match wins") compiled into one CASE expression.

Rules are data: a list of ``(condition, value)`` where ``condition`` is a
Column (or a ``(column, regex)`` pair tested with NULL-as-no-match) and
``value`` a Column or a literal.  The compiled expression is a single
``CASE WHEN`` that stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.nulls import matches


def _val(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v)


def _cond(c) -> Column:
    if isinstance(c, Column):
        return F.coalesce(c, F.lit(False))
    col, pattern = c[0], c[1]
    ignore_case = c[2] if len(c) > 2 else True
    return matches(col, pattern, ignore_case)


def ladder(rules: Sequence[tuple], default=None) -> Column:
    """Compile ordered rules to ``CASE WHEN c1 THEN v1 ... ELSE default END``."""
    expr = None
    for cond, value in rules:
        c = _cond(cond)
        expr = F.when(c, _val(value)) if expr is None else expr.when(c, _val(value))
    if expr is None:
        return _val(default)
    return expr.otherwise(_val(default)) if default is not None else expr


def regex_ladder(col, patterns: Sequence[tuple[str, str]], default=None,
                 ignore_case: bool = True) -> Column:
    """Label ``col`` by the first matching regex of ``(pattern, label)`` pairs."""
    return ladder([((col, p, ignore_case), label) for p, label in patterns], default)


def code_map(col, mapping: Mapping[str, str], default=None, keep_original: bool = False) -> Column:
    """Map codes to labels; unmatched codes get ``default`` or keep their value."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, label in mapping.items():
        cond = F.coalesce(c == F.lit(code), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = c if keep_original else _val(default)
    if expr is None:
        return fallback
    return expr.otherwise(fallback)
