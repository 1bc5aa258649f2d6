"""Sharding by the minimax contiguous partition of ordered atomic groups.

Law ``bytes``: every shard holds nearly the same number of bytes, and equal texts
stay together.  The texts' 64-bit hashes are ordered; a fixed number of equal hash
ranges (``n_atoms``) are the ordered atomic groups, so equal texts are always in
one atom.  The smallest feasible shard capacity is found by binary search, each
capacity being checked greedily over the atoms' sizes, and the shards are cut
under that capacity.

Everything on the data is DataFrame code.  The driver sees one sum per atom, at
most ``n_atoms`` rows whatever the input's size.  No text is shuffled.

Defined cases: a null text counts as empty (size ``overhead``); rows with a null or
repeated id are placed like any others; an empty table gives an empty result;
other columns of the input, whatever their names, are ignored.  One text larger
than a fair share makes its shard larger than the others: it is atomic.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import checkpointed

N_ATOMS = 65_536      # ordered atomic groups; bounds what the driver reads
SLOT_BUCKETS = 4_096  # rows of a shard are numbered in this many independent pieces
OVERHEAD = 16         # bytes a row takes beside its text


def shards_needed(prefix: list[int], capacity: int) -> list[int]:
    """For each start position: how many shards of ``capacity`` the greedy filling takes to the end.

    ``prefix`` holds running sums from 0; every single size must fit ``capacity``.
    """
    last = len(prefix) - 1
    need = [0] * (last + 1)
    for at in range(last - 1, -1, -1):
        need[at] = 1 + need[bisect_right(prefix, prefix[at] + capacity) - 1]
    return need


def smallest_capacity(sizes: list[int], n_shards: int) -> int:
    """Smallest capacity for which greedy filling of the ordered sizes takes at most ``n_shards`` shards."""
    prefix = [0, *accumulate(sizes)]

    def feasible(capacity: int) -> bool:
        at, used = 0, 0
        while at < len(sizes) and used <= n_shards:
            at, used = bisect_right(prefix, prefix[at] + capacity) - 1, used + 1
        return used <= n_shards

    largest = max(sizes, default=0)
    low, high = max(largest, -(-prefix[-1] // n_shards)), prefix[-1] // n_shards + largest + 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def cut_points(sizes: list[int], n_shards: int) -> list[int]:
    """Start positions of shards 1 .. n_shards-1.

    No shard exceeds the smallest capacity.  Within it, each shard ends as near to a
    fair share of what is left as the rest allows, and takes one atom at least, so shards are not left empty.
    """
    capacity, prefix = smallest_capacity(sizes, n_shards), [0, *accumulate(sizes)]
    need, cuts, at = shards_needed(prefix, capacity), [], 0
    for left in range(n_shards - 1, 0, -1):
        most = bisect_right(prefix, prefix[at] + capacity) - 1
        fair = prefix[at] + (prefix[-1] - prefix[at]) / (left + 1)
        end = bisect_right(prefix, fair) - 1
        if end < len(sizes) and prefix[end + 1] - fair < fair - prefix[end]:
            end += 1
        end = max(end, bisect_right(prefix, prefix[at]))  # at least one atom that holds something
        end = min(end, most)
        while need[end] > left:
            end += 1
        cuts.append(end)
        at = end
    return cuts


def assign_shards(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  overhead: int = OVERHEAD, n_atoms: int = N_ATOMS, buckets: int = SLOT_BUCKETS) -> DataFrame:
    """One row per document: ``id_col, size, text_crc32, atom, shard, slot``.

    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of
    (hash bucket of the id, id); each bucket is numbered on its own and added to the
    count of the buckets before it, so no task holds a whole shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = n_atoms.bit_length() - 1
    if 1 << bits != n_atoms:
        raise ValueError("n_atoms must be a power of two")
    rows = checkpointed(docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - bits).cast("int").alias("atom"),
    ))
    found = rows.groupBy("atom").agg(F.sum("size").alias("size")).collect()
    sizes = [0] * n_atoms
    for r in found:
        sizes[r["atom"]] = r["size"]
    shard: Column = F.lit(0)
    for cut in cut_points(sizes, n_shards):
        shard = shard + (F.col("atom") >= F.lit(cut)).cast("int")
    placed = rows.withColumn("shard", shard).withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
             .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy("shard", "_part").orderBy("_id", "text_crc32", "size")
    return (placed.withColumn("_at", F.row_number().over(within) - 1)
            .join(F.broadcast(bases), ["shard", "_part"])  # at most n_shards * buckets rows of 16 bytes
            .select(F.col("_id").alias(id_col), "size", "text_crc32", "atom", "shard",
                    (F.col("_base") + F.col("_at")).alias("slot")))
