"""One layout for operators that look along the rows of a group: rows dealt by (group, chunk of time), once.

A fill, a lag or an attribution needs two views of the same rows: the rows themselves, ordered inside their
chunk, and one summary row per chunk, ordered inside the group.  ``deal`` shuffles the rows by (group, chunk); both
views read that exchange, so what stands before it is computed once.  Spark reuses an exchange only between plans
that read the same columns from it, and it prunes columns that a view does not use.  The rows therefore travel as one
value, an array of one struct, whose fields are not pruned one by one; ``value`` takes a column out again.

``last_rows`` makes the summary without an aggregation: the running values of a chunk's last row are the chunk's.
Only the columns that it needs are sorted, and a hot group is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from martforge.operators.keys import surrogate_names, with_surrogates

CHUNK, ROW = "__chunk", "__row"


def deal(df: DataFrame, keys: Sequence[str], chunk: Column) -> DataFrame:
    """The rows of ``df`` as ``__row``, beside NULL-safe key columns of (``keys``, chunk), dealt out by these."""
    rows = with_surrogates(df.withColumn(CHUNK, chunk), [*keys, CHUNK])
    part = surrogate_names([*keys, CHUNK])
    packed = rows.select(*part, F.array(F.struct(*[F.col(f"`{c}`") for c in [*df.columns, CHUNK]])).alias(ROW))
    return packed.repartition(*part)


def value(name: str) -> Column:
    """A column of the dealt rows."""
    return F.element_at(ROW, 1).getField(name)


def in_chunk(part: Sequence[str], order: Sequence[str], ascending: bool = True) -> WindowSpec:
    """The rows of a chunk in order."""
    return Window.partitionBy(*part).orderBy(
        *[F.col(o).asc_nulls_first() if ascending else F.col(o).desc_nulls_last() for o in order])


def chunk_position(minute: str, number: Column) -> Column:
    """A row's place in a group's order as one number: the minute, then its ``number`` inside the minute (from 1)."""
    at = F.col(minute)
    minutes = (F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(at)) * 60 + F.minute(at)
    return F.coalesce(minutes, F.lit(-(1 << 31))) * F.lit(1 << 31) + number


def last_rows(dealt: DataFrame, part: Sequence[str], order: Sequence[str], keep: Sequence[str],
              running: Mapping[str, str] = {}, first: Mapping[str, str] = {}, any_of: Mapping[str, str] = {},
              opening: Mapping[str, str] = {}) -> DataFrame:
    """One row per chunk: its ``part`` keys, the ``keep`` columns of its last row, and by output name

    * ``running``: the last non-NULL value of a column,  * ``first``: the first non-NULL one,
    * ``any_of``: whether a flag is set anywhere,  * ``opening``: the value on the first row (NULL kept).
    """
    needed = dict.fromkeys([*order, *keep, *running.values(), *first.values(), *any_of.values(), *opening.values()])
    rows = dealt.select(*part, *[value(c).alias(c) for c in needed])
    ordered = in_chunk(part, order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {n: F.last(c, ignorenulls=True).over(so_far) for n, c in running.items()}
    # at the last row, a running frame has seen the whole chunk
    made |= {n: F.first(c, ignorenulls=True).over(so_far) for n, c in first.items()}
    made |= {n: F.max(c).over(so_far) for n, c in any_of.items()}
    made |= {n: F.first(c).over(so_far) for n, c in opening.items()}
    made["__end"] = F.lead(F.lit(1)).over(ordered).isNull()
    return rows.select(*part, *keep, *[c.alias(n) for n, c in made.items()]).where("__end").drop("__end")
