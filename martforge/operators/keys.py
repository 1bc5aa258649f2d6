"""NULL-safe surrogate keys.

Windows and ``groupBy`` treat NULL as its own group, but an equi-join does
not.  Operators that aggregate per group and join the result back (fills,
lag across chunks) therefore partition and join on a surrogate pair per key:
``coalesce(k, typed default)`` plus ``k IS NULL``.  Plain equality on these
columns keeps NULL groups intact *and* lets the join reuse the hash
partitioning of the preceding window (no second shuffle of the big side).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "__nk_"
NULL_PREFIX = "__nn_"


def _default_for(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date(1970, 1, 1))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(_dt.datetime(1970, 1, 1)).cast(dtype)
    raise TypeError(f"no surrogate default for key type {dtype}")


def surrogate_names(keys: list[str]) -> list[str]:
    out = []
    for k in keys:
        out += [PREFIX + k, NULL_PREFIX + k]
    return out


def with_surrogates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add surrogate columns for ``keys`` unless they already exist (so repeated
    operators on the same keys share one partitioning)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for k in keys:
        if PREFIX + k in types:
            continue
        new[PREFIX + k] = F.coalesce(F.col(k), _default_for(types[k]))
        new[NULL_PREFIX + k] = F.col(k).isNull()
    return df.withColumns(new) if new else df
