"""Address ranges -> attributes, by one equi join.

An address is its 128 bits as text (IPv4 as the last 32 of them, behind the usual prefix of mapped addresses).  A range
is cut into blocks: bit prefixes whose addresses all lie in it, at most 256 of them.  An address lies in a block
exactly if the block's prefix is the beginning of its bits, so the lookup joins on the prefix, for each of the prefix
lengths that the ranges have (at most 129, and few where ranges are networks).  No address is compared with
ranges that it does not meet, and a range of any size costs the same.

Of several ranges that hold an address, the one that begins last wins, then the one that ends first: of nested
ranges the innermost.  NULL and malformed addresses have no bits and no range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.operators.history import top_row

BITS = 128
_MAPPED = "0" * 80 + "1" * 16


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def address_bits(address) -> Column:
    """The 128 bits of an IPv4 or IPv6 address as text; NULL if it is neither."""
    a = _c(address)
    four = F.transform(F.split(a, r"\."), lambda x: F.lpad(F.bin(x.try_cast("long")), 8, "0"))
    byte = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    parts = F.split(a, "::")
    groups = lambda i: F.filter(F.split(F.coalesce(F.get(parts, F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    left, right = groups(0), groups(1)
    gap = F.lit(8) - F.size(left) - F.size(right)
    eight = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), right)
    six = F.transform(eight, lambda g: F.lpad(F.conv(g, 16, 2), 16, "0"))
    sound = a.rlike(r"^[0-9A-Fa-f:]{2,39}$") & ~a.rlike(r"[0-9A-Fa-f]{5}|:::|::.*::|^:[^:]|[^:]:$")
    fits = F.when(a.contains("::"), gap >= 1).otherwise((gap == 0) & a.contains(":"))
    return (F.when(a.rlike(rf"^{byte}(?:\.{byte}){{3}}$"), F.concat(F.lit(_MAPPED), F.array_join(four, "")))
            .when(sound & fits, F.array_join(six, "")))


def range_blocks(ranges: DataFrame, first: str, last: str, values: list[str]) -> DataFrame:
    """``__prefix, __first, __last, values``: the blocks of each range (none for a range that ends before it begins)."""
    rows = ranges.select(address_bits(first).alias("__first"), address_bits(last).alias("__last"), *values)
    lo, hi = F.col("__first"), F.col("__last")
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BITS)), lambda i: F.substring(lo, F.lit(1), i) == F.substring(hi, F.lit(1), i)))
    rows = rows.where(lo <= hi).withColumn("__same", same)
    # the shortest beginnings of both ends below which nothing lies outside
    begin = F.greatest(F.length(F.rtrim(lo, F.lit("0"))), F.least(F.col("__same") + 1, F.lit(BITS)))
    end = F.greatest(F.length(F.rtrim(hi, F.lit("1"))), F.least(F.col("__same") + 1, F.lit(BITS)))
    rows = rows.withColumns({"__begin": begin, "__end": end})
    at = F.col("__same") + 2  # positions behind the one at which the ends part

    def siblings(bits: Column, upto: Column, own: str, other: str) -> Column:
        places = F.when(upto >= at, F.sequence(at, upto)).otherwise(F.array().cast("array<int>"))
        turned = F.filter(places, lambda i: F.substring(bits, i, F.lit(1)) == own)
        return F.transform(turned, lambda i: F.concat(F.substring(bits, F.lit(1), i - 1), F.lit(other)))

    ends = F.array(F.substring(lo, F.lit(1), F.col("__begin")), F.substring(hi, F.lit(1), F.col("__end")))
    whole = (F.col("__begin") == F.col("__same") + 1) & (F.col("__end") == F.col("__same") + 1)
    blocks = F.when(whole, F.array(F.substring(lo, F.lit(1), F.col("__same")))).otherwise(F.array_distinct(F.concat(
        ends, siblings(lo, F.col("__begin"), "0", "1"), siblings(hi, F.col("__end"), "1", "0"))))
    return rows.select(F.explode(blocks).alias("__prefix"), "__first", "__last", *values)


def lookup(addresses: DataFrame, address: str, ranges: DataFrame, first: str, last: str, values: list[str]) -> DataFrame:
    """The distinct ``address`` values of ``addresses`` that lie in a range, with the ``values`` of the innermost one."""
    blocks = range_blocks(ranges, first, last, values)
    lengths = blocks.select(F.length("__prefix").alias("n")).distinct().agg(F.collect_list("n").alias("__lengths"))  # 129 at most
    known = addresses.select(address).distinct().withColumn("__bits", address_bits(address)).where("__bits IS NOT NULL")
    # one row joined to every address: the list of lengths
    tried = known.withColumn("__one", F.lit(1)).join(F.broadcast(lengths.withColumn("__one", F.lit(1))), "__one").select(
        address, F.explode("__lengths").alias("__n"), "__bits")
    prefixed = tried.select(address, F.substring("__bits", F.lit(1), F.col("__n")).alias("__prefix"))
    found = prefixed.join(blocks, "__prefix")
    best = top_row(found, [address], [F.desc("__first"), F.asc("__last"), *[F.asc_nulls_last(v) for v in values]])
    return best.select(address, *values)
