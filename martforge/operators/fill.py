"""Group-wise fills in a fixed order (last observation carried forward / backward).

``fill(df, by, order, cols, direction)`` fills NULLs of ``cols`` within each
``by`` group, rows ordered by ``order`` (ascending; the caller supplies a
unique tiebreak such as an event id).  Directions: ``down``, ``up``,
``downup`` (down, then leading NULLs from the first value) and ``updown``.

Every frame is a *running* frame (``unboundedPreceding .. currentRow``);
"up" runs the same frame over the reversed order.  A ``currentRow ..
unboundedFollowing`` frame is quadratic in Spark and is never used.

Skew: a plain window puts a whole group into one task.  With ``chunk`` (a
column that is non-decreasing in ``order``, e.g. the minute of the event
time) the scan is segmented over one layout (``operators.layout``):

1. the rows are dealt by (group, chunk), once,
2. a running window inside each chunk gives the local values,
3. the chunk's last row is its summary; a window over the summaries gives
   the nearest non-NULL value of earlier / later chunks,
4. a join brings it back on (group, chunk), as which the rows are dealt.

A hot group is then spread over as many tasks as it has chunks.
``chunk_by`` names the subset of ``by`` that, together with the chunk,
identifies a chunk (e.g. ``by=[visitor, day]``, ``chunk=minute``,
``chunk_by=[visitor]``, since the minute determines the day).  Without
``chunk`` (no column that grows with the order) a plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.keys import surrogate_names
from martforge.operators.layout import CHUNK, deal, in_chunk, last_rows, value

_DIRECTIONS = ("down", "up", "downup", "updown")


def _order_cols(order: Sequence[str], ascending: bool) -> list[Column]:
    return [F.col(o).asc_nulls_first() if ascending else F.col(o).desc_nulls_last() for o in order]


def fill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str],
         direction: str = "down", chunk: Column | None = None,
         chunk_by: Sequence[str] | None = None) -> DataFrame:
    if direction not in _DIRECTIONS:
        raise ValueError(f"direction must be one of {_DIRECTIONS}")
    by, order, cols = list(by), list(order), list(cols)
    need_down = direction != "up"
    need_up = direction != "down"
    if chunk is None:
        return _fill_plain(df, by, order, cols, direction, need_down, need_up)
    return _fill_chunked(df, by, order, cols, direction, need_down, need_up, chunk,
                         list(chunk_by) if chunk_by is not None else by)


def _combine(direction: str, down: Column | None, up: Column | None) -> Column:
    if direction == "down":
        return down
    if direction == "up":
        return up
    if direction == "downup":
        return F.coalesce(down, up)
    return F.coalesce(up, down)


def _fill_plain(df, by, order, cols, direction, need_down, need_up):
    w_down = Window.partitionBy(*by).orderBy(*_order_cols(order, True)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    w_up = Window.partitionBy(*by).orderBy(*_order_cols(order, False)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    new = {}
    for c in cols:
        down = F.last(c, ignorenulls=True).over(w_down) if need_down else None
        up = F.last(c, ignorenulls=True).over(w_up) if need_up else None
        new[c] = _combine(direction, down, up)
    return df.withColumns(new)


def _fill_chunked(df, by, order, cols, direction, need_down, need_up, chunk, chunk_by):
    extra = [k for k in by if k not in chunk_by]
    part, group = surrogate_names([*chunk_by, CHUNK]), [*surrogate_names(chunk_by), *extra]
    dealt = deal(df, chunk_by, chunk)
    # a chunk's contribution to others, and what it takes from them (one row per chunk)
    ends = last_rows(dealt, part, order, [*extra, CHUNK], {f"__sl_{c}": c for c in cols} if need_down else {},
                     {f"__sf_{c}": c for c in cols} if need_up else {})
    before = Window.partitionBy(*group).orderBy(F.col(CHUNK).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*group).orderBy(F.col(CHUNK).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for c in cols:
        if need_down:
            carried.append(F.last(f"__sl_{c}", ignorenulls=True).over(before).alias(f"__cd_{c}"))
        if need_up:
            carried.append(F.last(f"__sf_{c}", ignorenulls=True).over(after).alias(f"__cu_{c}"))
    carry = ends.select(*part, *carried)
    # the local values
    rows = dealt.select(*part, *[value(c).alias(c) for c in df.columns])
    down = in_chunk(part, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = in_chunk(part, order, ascending=False).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {}
    for c in cols:
        if need_down:
            local[f"__ld_{c}"] = F.last(c, ignorenulls=True).over(down)
        if need_up:
            local[f"__lu_{c}"] = F.last(c, ignorenulls=True).over(up)
    joined = rows.withColumns(local).join(carry, on=part, how="left")
    new = {c: _combine(direction, F.coalesce(f"__ld_{c}", f"__cd_{c}") if need_down else None,
                       F.coalesce(f"__lu_{c}", f"__cu_{c}") if need_up else None) for c in cols}
    return joined.withColumns(new).select(*df.columns)


def first_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str], col: str,
                   out: str) -> DataFrame:
    """Value of ``col`` on the first row of each group (NULL kept, not skipped),
    as a grouped aggregate (partial aggregation, no window)."""
    ordkey = F.struct(*[F.col(o) for o in order])
    return df.groupBy(*by).agg(F.min_by(F.col(col), ordkey).alias(out))
