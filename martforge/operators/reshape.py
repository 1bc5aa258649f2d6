"""Reshape: long -> wide pivot with an explicit value list (one pass, no
distinct-values job) and a fill for absent cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "min": F.min, "max": F.max, "first": F.first, "count": F.count}


def pivot(df: DataFrame, by: Sequence[str], pivot_col: str, values: Sequence[str], value_col: str,
          agg: str = "sum", fill=None, names: Sequence[str] | None = None) -> DataFrame:
    """``spread(pivot_col, value_col, fill)``; ``names`` renames the value columns."""
    out = df.groupBy(*by).pivot(pivot_col, list(values)).agg(_AGGS[agg](value_col))
    if fill is not None:
        out = out.fillna(fill, subset=list(values))
    if names:
        out = out.withColumnsRenamed(dict(zip(values, names)))
    return out
