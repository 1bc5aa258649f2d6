"""First-seen mode: most frequent non-NULL value per group, ties to the value
seen first, NULL when the group has no value.

The rows are reduced before anything else, by a hash aggregation with map-side
partial sums: (group, all columns) -> count and first position, where the
position is one fixed-width number.  Only this small result is stacked into
(column, value) rows, counted per value, and cut to the best value per
column by a rank over numbers (limited map-side).  No aggregation holds text in
its buffers, no task gathers a group's rows, and any number of modes costs the same.

A textual tiebreak compares as text: rows are numbered inside their minute, by
(group, minute), so a hot group is spread over its minutes.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.dates import minute_trunc
from martforge.operators.layout import chunk_position


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.TimestampType, T.TimestampNTZType)


def _positioned(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``__at``, the place of a row in ``order`` as one comparable number.

    One number or a time and a number fit a LONG or DECIMAL.  A time and text are numbered inside each
    (group, minute).  Other orders compare as a struct.
    """
    types = [df.schema[o].dataType for o in order]
    first = F.col(order[0])
    if len(order) == 1 and isinstance(types[0], WHOLE):
        return df.withColumn("__at", first.cast("long"))
    if len(order) == 2 and isinstance(types[0], TIMES) and isinstance(types[1], T.StringType):
        minute = minute_trunc(order[0])
        inside = Window.partitionBy(*by, "__minute").orderBy(*[F.col(o).asc_nulls_first() for o in order])
        return df.withColumn("__minute", minute).withColumn(
            "__at", chunk_position("__minute", F.row_number().over(inside))).drop("__minute")
    if not isinstance(types[0], (*WHOLE, T.TimestampNTZType)) or len(order) > 2 or not isinstance(types[-1], (
            *WHOLE, T.TimestampNTZType) if len(order) == 1 else WHOLE):
        return df.withColumn("__at", F.struct(*[F.col(o) for o in order]))
    place = first
    if isinstance(types[0], T.TimestampNTZType):
        seconds = (F.date_diff(F.to_date(first), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(first)) * 60
        micros = F.extract(F.lit("SECOND"), first).cast("decimal(18,6)") * 1_000_000
        place = ((seconds + F.minute(first)) * 60).cast("decimal(19,0)") * 1_000_000 + micros
    place = F.coalesce(place.cast("decimal(18,0)"), F.lit(-(10 ** 18 - 1)).cast("decimal(18,0)"))
    if len(order) == 1:
        return df.withColumn("__at", place.cast("decimal(38,0)"))
    tie = F.coalesce(F.col(order[1]).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return df.withColumn("__at", (place * F.lit(Decimal(10 ** 19))).cast("decimal(38,0)") + tie)


def modes(df: DataFrame, by: Sequence[str], cols: Sequence[str], order: Sequence[str],
          firsts: dict[str, str] | None = None) -> DataFrame:
    """One row per ``by`` group with the first-seen mode of each of ``cols``.

    ``firsts`` maps a column of ``cols`` to an output name for the value on the
    group's first row (NULL kept), taken from the same reduced rows.
    """
    by, cols, order = list(by), list(cols), list(order)
    firsts = dict(firsts or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [f"__v{i}" for i in range(len(cols))]
    rows = _positioned(df.select(*dict.fromkeys([*by, *cols, *order])), by, order)
    reduced = (rows.select(*by, *[F.col(c).cast("string").alias(v) for c, v in zip(cols, values)], "__at")
               .groupBy(*by, *values).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__at")))
    # (wanted, column) -> value: the mode of each column, and the first value of some
    wanted = [*[("m", c, v) for c, v in zip(cols, values)], *[("f", c, values[cols.index(c)]) for c in firsts]]
    if len(wanted) == 1:
        stacked = reduced.select(*by, F.lit("m").alias("kind"), F.lit(cols[0]).alias("name"),
                                 F.col(values[0]).alias("value"), "__n", "__at")
    else:
        stacked = reduced.select(*by, "__n", "__at", F.inline(F.array(*[
            F.struct(F.lit(k).alias("kind"), F.lit(c).alias("name"), F.col(v).alias("value")) for k, c, v in wanted])))
    counted = stacked.groupBy(*by, "kind", "name", "value").agg(F.sum("__n").alias("__n"), F.min("__at").alias("__first"))
    # a first value ranks by its position alone, a mode by its count before that; no value comes last
    is_mode = F.col("kind") == "m"
    best = Window.partitionBy(*by, "kind", "name").orderBy(
        is_mode & F.col("value").isNull(), F.when(is_mode, -F.col("__n")), "__first")
    picked = counted.withColumn("__pos", F.row_number().over(best)).where(F.col("__pos") == 1)
    if len(wanted) == 1:
        return picked.select(*by, F.col("value").cast(types[cols[0]]).alias(cols[0]))
    # one entry per wanted column
    gathered = picked.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat("kind", "name"), "value"))).alias("__found"))
    return gathered.select(*by, *[F.col("__found")[f"m{c}"].cast(types[c]).alias(c) for c in cols],
                           *[F.col("__found")[f"f{c}"].cast(types[c]).alias(name) for c, name in firsts.items()])


def mode(df: DataFrame, by: Sequence[str], col: str, order: Sequence[str], out: str | None = None) -> DataFrame:
    res = modes(df, by, [col], order)
    return res.withColumnRenamed(col, out) if out else res
