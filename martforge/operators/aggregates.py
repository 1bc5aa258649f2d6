"""Aggregate helpers: top-k by count, ordered distinct string aggregate,
type-driven NULL replacement, date spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_k_by_count(df: DataFrame, key: str, k: int, count_col: str = "n") -> DataFrame:
    """Top ``k`` keys by row count, ties by key ascending.

    ``groupBy`` aggregates map-side; the ordered limit plans as
    ``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc_nulls_first()).limit(k)


def string_agg_distinct(col, sep: str = "; ", na: str | None = "NA") -> Column:
    """Sorted distinct values joined by ``sep``; NULL prints as ``na`` when given."""
    c = F.col(col) if isinstance(col, str) else col
    if na is not None:
        c = F.coalesce(c, F.lit(na))
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def join_distinct(df: DataFrame, by: Sequence[str], col: str, out: str, sep: str = "; ", na: str | None = "NA") -> DataFrame:
    """``by, out``: the sorted distinct values of ``col`` per group, joined by ``sep``; NULL prints as ``na`` when given.

    A hash aggregation reduces copies first, so a group's buffer holds each of its values once, however many rows
    it has: the bound is the length of the result text.
    """
    c = F.col(col) if na is None else F.coalesce(F.col(col), F.lit(na))
    pairs = df.select(*by, c.alias("__text")).distinct()
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    return pairs.groupBy(*by).agg(F.expr(f"coalesce(listagg(__text, '{quoted}') WITHIN GROUP (ORDER BY __text), '')").alias(out))


def fill_by_type(df: DataFrame, numeric=None, text=None) -> DataFrame:
    """Replace NULL in every numeric column with ``numeric`` and/or every string
    column with ``text`` (the schema is inspected, not the data)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df
    if numeric is not None and num:
        out = out.fillna(numeric, subset=num)
    if text is not None and txt:
        out = out.fillna(text, subset=txt)
    return out


def date_spine(df: DataFrame, start: Column, end: Column, out: str = "day") -> DataFrame:
    """All days between ``start`` and ``end`` (inclusive) from a one-row aggregate of ``df``."""
    bounds = df.agg(start.alias("__s"), end.alias("__e"))
    return bounds.select(F.explode(F.sequence(F.col("__s"), F.col("__e"))).alias(out))


def days_per_week(spine: DataFrame, day_col: str = "day") -> DataFrame:
    return (spine.groupBy(F.trunc(F.col(day_col), "week").alias("report_week"))
            .agg(F.count(F.lit(1)).alias("days")))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def min_if(col, cond: Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.min(F.when(cond, c))


def cond_sums(col, neg: str = "discount", pos: str = "gross") -> Sequence[Column]:
    c = F.col(col) if isinstance(col, str) else col
    return [F.sum(F.when(c < 0, c).otherwise(F.lit(0))).alias(neg),
            F.sum(F.when(c > 0, c).otherwise(F.lit(0))).alias(pos)]
