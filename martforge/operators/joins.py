"""Joins with the source's rules: NULL keys match each other, natural keys are
resolved explicitly.  No join is hinted: Spark broadcasts a side from its size in
bytes, at planning or, from what a stage really wrote, at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.nulls import null_safe_on

#: Pieces of the rows without a key in an anti join: NULL matches NULL, and may be the most frequent key.
NULL_SALTS = 32


def _pairs(on) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Join where NULL keys match (``<=>``).  ``on`` holds names or (left, right) pairs.

    For same-named keys the right copy is dropped (natural-join output).
    """
    pairs = _pairs(on)
    r = right
    rename = {}
    for lk, rk in pairs:
        if rk in left.columns:
            rename[rk] = f"__r_{rk}"
    if rename:
        r = r.withColumnsRenamed(rename)
    rpairs = [(lk, rename.get(rk, rk)) for lk, rk in pairs]
    cond = null_safe_on(left, r, rpairs)
    out = left.join(r, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi"):
        return out
    return out.drop(*[rk for _, rk in rpairs if rk.startswith("__r_")])


def null_salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``null_safe_join`` on ``key`` for a ``right`` side with few rows per key and a ``left`` side with many NULLs.

    Rows without a key are spread over ``NULL_SALTS`` pieces, and the right side's NULL rows are repeated for each.
    """
    salts = F.when(F.col(key).isNull(), F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))).otherwise(F.array(F.lit(0)))
    r = right.withColumn("__r_salt", F.explode(salts)).withColumnRenamed(key, "__r_key")
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(NULL_SALTS)).cast("int")
                  ).otherwise(F.lit(0))
    l = left.withColumn("__salt", salt)
    return l.join(r, l[key].eqNullSafe(r["__r_key"]) & (l["__salt"] == r["__r_salt"]), how).drop(
        "__salt", "__r_salt", "__r_key")


def anti_join_any(df: DataFrame, key: str, lists: Sequence[DataFrame], list_key: str | None = None) -> DataFrame:
    """Drop rows whose ``key`` is in any of ``lists`` (NULL matches NULL).

    The lists are unioned and de-duplicated first (one anti join instead of
    several).  Rows without a key are spread over ``NULL_SALTS`` pieces, so a hot
    NULL does not meet in one task.
    """
    lk = list_key or key
    keys = None
    for lst in lists:
        col = lst.columns[0] if lk not in lst.columns else lk
        part = lst.select(F.col(col).alias("__excl"))
        keys = part if keys is None else keys.unionByName(part)
    if keys is None:
        return df
    salts = F.when(F.col("__excl").isNull(), F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = keys.distinct().withColumn("__excl_salt", F.explode(salts))
    salt = F.when(df[key].isNull(), F.pmod(F.xxhash64(*[df[c] for c in df.columns]), F.lit(NULL_SALTS)).cast("int")
                  ).otherwise(F.lit(0))
    return df.join(keys, df[key].eqNullSafe(keys["__excl"]) & (salt == keys["__excl_salt"]), "left_anti")
