"""Set operations: positional UNION (distinct), union-all by name with a source
tag, and appending a constant sentinel row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(legs: Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    """SQL ``UNION`` by position, output names of the first leg."""
    legs = list(legs)
    names = legs[0].columns
    out = legs[0]
    for leg in legs[1:]:
        out = out.union(leg.toDF(*names))
    return out.distinct() if distinct else out


def union_tagged(legs: Sequence[tuple[str, DataFrame]], tag_col: str = "source") -> DataFrame:
    """Union-all by column name, each leg tagged with a constant."""
    out = None
    for tag, leg in legs:
        t = leg.withColumn(tag_col, F.lit(tag))
        out = t if out is None else out.unionByName(t)
    return out


def append_row(df: DataFrame, values: Sequence) -> DataFrame:
    """Append one constant row (e.g. an all-'Not Specified' sentinel)."""
    row = df.sparkSession.range(1).select(*[
        F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, df.schema.fields)])
    return df.unionByName(row)
