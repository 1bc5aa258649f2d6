"""Versioned-table operators: latest version per key, top row per group, change points.

``latest_version`` is ``rank() over (partition by key order by t desc) = 1``
with NULL ordering first (a NULL version time ranks as the latest, as in the
source warehouse) and ties kept.  Catalyst plans a ``rank = 1`` filter as a
partial ``WindowGroupLimit`` *before* the shuffle, so each map task forwards
only its own top rows of a key: a hot key is cut down map-side.

``change_points`` keeps rows whose value differs from the previous row of
the group (``lag`` with a default; NULL comparisons drop the row).  With a
``chunk`` column the lag is segmented like the fills: the first row of a
chunk takes the last value of the previous chunk from a small summary
(``operators.layout``).  Without ``chunk`` a plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.keys import surrogate_names
from martforge.operators.layout import CHUNK, deal, in_chunk, last_rows, value



def _ordering(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_version(df: DataFrame, keys: Sequence[str], version_col: str,
                   nulls_first: bool = True) -> DataFrame:
    """All rows holding the latest ``version_col`` of each key (ties kept)."""
    o = F.col(version_col).desc_nulls_first() if nulls_first else F.col(version_col).desc_nulls_last()
    w = Window.partitionBy(*keys).orderBy(o)
    return df.withColumn("__pos", F.rank().over(w)).where(F.col("__pos") == 1).drop("__pos")


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Exactly one row per group: the first by ``order`` (give a full tiebreak)."""
    w = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn("__pos", F.row_number().over(w)).where(F.col("__pos") == 1).drop("__pos")


def lag_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, out: str,
                 default=None, chunk: Column | None = None,
                 chunk_by: Sequence[str] | None = None) -> DataFrame:
    """``out = lag(col, 1, default)`` within ``by`` ordered by ``order`` (ascending)."""
    by, order = list(by), list(order)
    dflt = F.lit(default) if default is not None else F.lit(None)
    if chunk is None:
        w = Window.partitionBy(*by).orderBy(*[F.col(o).asc_nulls_first() for o in order])
        return df.withColumn(out, F.lag(col, 1, default).over(w))

    chunk_by = list(chunk_by) if chunk_by is not None else by
    extra = [k for k in by if k not in chunk_by]
    part, group = surrogate_names([*chunk_by, CHUNK]), [*surrogate_names(chunk_by), *extra]
    dealt = deal(df, chunk_by, chunk)
    between = Window.partitionBy(*group).orderBy(F.col(CHUNK).asc_nulls_first())
    carry = last_rows(dealt, part, order, list(dict.fromkeys([*extra, CHUNK, col]))).select(
        *part, F.lag(col, 1).over(between).alias("__prev"), F.lag(F.lit(1), 1).over(between).isNotNull().alias("__has_prev"))
    ordered = in_chunk(part, order)
    rows = dealt.select(*part, *[value(c).alias(c) for c in df.columns])
    local = rows.withColumns({"__lag": F.lag(col, 1).over(ordered), "__first": F.lag(F.lit(1), 1).over(ordered).isNull()})
    previous = (F.when(~F.col("__first"), F.col("__lag")).when(F.col("__has_prev"), F.col("__prev"))
                .otherwise(dflt.cast(df.schema[col].dataType)))
    return local.join(carry, on=part, how="left").withColumn(out, previous).select(*df.columns, out)


def change_points(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str,
                  default="1", chunk: Column | None = None,
                  chunk_by: Sequence[str] | None = None) -> DataFrame:
    """Rows where ``col`` differs from the previous row's value (``default`` before the first)."""
    with_prev = lag_in_group(df, by, order, col, "__prev_val", default, chunk, chunk_by)
    return with_prev.where(F.col(col) != F.col("__prev_val")).drop("__prev_val")
