"""Channel attribution of a visitor's events, in one pass over chunks of time.

The source applies four fills in a row: several columns down-up within a
visitor-day, a promotion of one of them and again down-up, a label ladder, down
per visitor over all days, up within the visitor-day.  Written as four fills,
each needs the whole table again.  They compose:

* after the first down-up fill a visitor-day has a medium on all of its rows or
  on none, so the promotion and the second fill reduce to one flag per day;
* the labelled medium is then NULL only on rows of days without medium and flag,
  where it depends on the row alone;
* the last two fills need, per chunk, the labelled medium of its last row.

So every carry follows from one summary row per (visitor, chunk), with chunks
of one minute: running windows inside a chunk give the local values and, at its
last row, the summary; windows over the summaries give what earlier and later
chunks contribute, and one join brings it back.  Rows and summaries read one
exchange (``operators.layout``), so what stands before it is computed once.  A
visitor with a third of all rows is spread over as many tasks as it has
minutes; the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.dates import minute_trunc
from martforge.operators.keys import surrogate_names
from martforge.operators.layout import CHUNK, chunk_position, deal, in_chunk, last_rows, value


def attribute(df: DataFrame, visitor: str, day: str, order: Sequence[str], cols: Sequence[str], medium: str,
              label: Callable[[Column], Column], missing: Column, promote: Column | None = None,
              promoted: str = "organic", landing: tuple[str, str] | None = None,
              unknown: str | None = None, position: str | None = None) -> DataFrame:
    """``df`` with ``cols`` filled per visitor-day and ``medium`` (one of them) attributed.

    ``label`` maps a known medium, ``missing`` is the row's label without one (may be NULL), ``promote`` marks
    rows that give their whole day the medium ``promoted`` if it has none.  ``landing`` is (source column, name):
    its value on the first row of the visitor-day, NULL kept.  ``order`` begins with the event time.  ``position`` names
    a column for a row's place in the visitor's ``order``, as one number.
    """
    cols, order = list(cols), list(order)
    marked = df.withColumns({"__miss": missing, "__prom": F.coalesce(promote, F.lit(False)) if promote is not None
                             else F.lit(False)})
    dealt = deal(marked, [visitor], minute_trunc(order[0]))
    part, person = surrogate_names([visitor, CHUNK]), surrogate_names([visitor])
    values = [*cols, "__miss"]

    # what each chunk contributes to others
    summary = last_rows(dealt, part, order, [day, CHUNK], {f"__last_{c}": c for c in values},
                        {f"__first_{c}": c for c in values}, {"__p": "__prom"},
                        {"__land": landing[0]} if landing else {})
    ordered = Window.partitionBy(*person, day).orderBy(F.col(CHUNK).asc_nulls_first())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = (Window.partitionBy(*person).orderBy(F.col(day).asc_nulls_first(), F.col(CHUNK).asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = summary.select(
        *part, day, CHUNK, f"__last_{medium}", "__last___miss",
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__in_{c}") for c in cols],
        *[F.first(f"__first_{c}", ignorenulls=True).over(whole).alias(f"__day_{c}") for c in values],
        F.max("__p").over(whole).alias("__day_p"),
        *([F.first("__land").over(whole).alias("__day_land")] if landing else []))
    # the labelled medium of the chunk's last row that has one
    last_label = (F.when(F.col(f"__day_{medium}").isNotNull(), label(F.coalesce(
        F.col(f"__last_{medium}"), F.col(f"__in_{medium}"), F.col(f"__day_{medium}"))))
        .when(F.col("__day_p"), label(F.lit(promoted))).otherwise(F.col("__last___miss")))
    carried = carried.withColumn("__label", last_label)
    carried = carried.withColumn("__in_label", F.last("__label", ignorenulls=True).over(earlier)).select(
        *part, *[f"__in_{c}" for c in cols], *[f"__day_{c}" for c in values], "__day_p", "__in_label",
        *(["__day_land"] if landing else []))

    inside = in_chunk(part, order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.select(*part, *[value(c).alias(c) for c in [*marked.columns, CHUNK]])
    local = rows.withColumns({f"__run_{c}": F.last(c, ignorenulls=True).over(running) for c in values})
    if position:
        local = local.withColumn(position, chunk_position(CHUNK, F.row_number().over(inside)))
    out = local.join(carried, part, "left")
    filled = {c: F.coalesce(F.col(f"__run_{c}"), F.col(f"__in_{c}"), F.col(f"__day_{c}")) for c in cols}
    own = (F.when(F.col(f"__day_{medium}").isNotNull(), label(filled[medium]))
           .when(F.col("__day_p"), label(F.lit(promoted))).otherwise(F.col("__run___miss")))
    final = F.coalesce(own, F.col("__in_label"), F.col("__day___miss"), *([F.lit(unknown)] if unknown else []))
    made = {**filled, medium: final}
    result = [made.get(c, F.col(c)).alias(c) for c in df.columns]
    if landing:
        result.append(F.col("__day_land").alias(landing[1]))
    return out.select(*result, *([position] if position else []))
