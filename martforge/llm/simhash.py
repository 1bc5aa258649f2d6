"""SimHash near-dedup over vantage-point shards.

Fingerprint: A-Z lower-cased, words between ASCII white space, word shingles (repeats
count), XXH64 with seed 42 of each; a bit is set if it is set in over half the hashes.

Links: two fingerprints that differ in at most ``max_bits`` bits.  Components: the
smallest id reachable.  Pairs are found exactly, by Hamming distances to vantage points:

* Equal fingerprints are one point, with their smallest id.
* The 64 bits are cut into ``SLICES`` slices of equal width.  On one slice the Hamming
  distance is a metric that never exceeds the full one, so for any vantage point v the triangle
  inequality gives |d(x,v) - d(y,v)| <= d(x,y) slice by slice, and the sum of these over
  all slices is at most d(x,y).  A point's distances to the slices' vantage points are
  its path in the tree; a shard is one path.
* Points within ``max_bits`` of each other have paths that differ by ``max_bits`` in all at
  most, so each has the other, or a path between them, within half of that: each
  point enters its own shard and the shards whose boundary it overlaps (paths that
  differ by ``ceil(max_bits / 2)`` in all).  No pair is missed, and shards stay small at any
  number of points: shards are as many as paths, not as any one key's rows.
* Inside a shard a vantage-point tree with full distances finds the pairs, pruning branches by the
  triangle bounds.  The shard returns a forest that connects what its pairs connect,
  so edges never outnumber its points.

Components of the forest's edges come from alternating large-star and small-star steps, each
a shuffle of edges, cut by a reliable checkpoint.  Nothing is collected.

Defined cases: null and empty texts have no words and fingerprint 0, which links like any
other; fewer words than a shingle are one shingle; repeated ids share their
component; rows with a null id are kept and get their component's smallest id (null if it
has none); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import checkpointed, map_batches, small_batches, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SLICES = 16
LEAF = 64  # points below which a branch is compared directly


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    cut = map(line.__getitem__, map(slice, starts[:n].tolist(), last.tolist()))
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, cut, repeat(SEED))), np.uint8)
    return majority(hashes.reshape(n, 8))


#: For each byte value its 8 bits, highest first, as eight 8-bit lanes of one 64-bit word.
_LANES = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)).view(np.uint64).ravel()


def majority(digests: np.ndarray) -> int:
    """Bits set in over half of n big-endian 64-bit digests (an (n, 8) byte array)."""
    n = len(digests)
    totals = np.zeros((8, 8), np.int64)
    for at in range(0, n, 255):  # 255 additions fit an 8-bit lane
        lanes = _LANES[digests[at:at + 255]].sum(axis=0, dtype=np.uint64)
        totals += lanes.view(np.uint8).reshape(8, 8)
    return int.from_bytes(np.packbits(totals * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` with the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batch: pa.RecordBatch) -> dict:
        fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return {"id": batch.column(0), "fp": pa.array(np.array(fps, np.uint64).view(np.int64))}

    src = docs.select(F.col(id_col).cast("long").alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return map_batches(src, run, "id long, fp long", schema)


def paths(points: np.ndarray, slices: int = SLICES) -> np.ndarray:
    """Distances of each point to the slices' vantage points (their zeros), shape (n, slices)."""
    width = 64 // slices
    shifts = np.arange(slices, dtype=np.uint64) * np.uint64(width)
    return np.bitwise_count((points[:, None] >> shifts) & np.uint64((1 << width) - 1)).astype(np.int64)


def shard_keys(points: np.ndarray, max_bits: int, slices: int = SLICES) -> np.ndarray:
    """Keys of every shard whose path differs from the point's by half of ``max_bits`` in all at most."""
    width = 64 // slices
    base = (width + 1) + 2 * ((max_bits + 1) // 2)
    weights = np.array([base ** k for k in range(slices)], dtype=object)
    if base ** slices >= 1 << 63:
        raise ValueError("too many slices for one 64-bit key")
    weights = weights.astype(np.int64)
    own = ((paths(points, slices) + (max_bits + 1) // 2) * weights).sum(axis=1)
    steps = {0}
    for _ in range((max_bits + 1) // 2):
        steps |= {s + sign * int(w) for s in steps for w in weights for sign in (1, -1)}
    return own[:, None] + np.array(sorted(steps), np.int64)[None, :]


def close_pairs(points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of distinct points within ``max_bits``: a vantage-point tree joined with itself."""
    left, right = [], []

    def direct(a: np.ndarray, b: np.ndarray | None) -> None:
        if b is None:
            i, j = np.triu_indices(len(a), 1)
            i, j = a[i], a[j]
        else:
            i, j = np.repeat(a, len(b)), np.tile(b, len(a))
        near = np.bitwise_count(points[i] ^ points[j]) <= max_bits
        left.append(i[near])
        right.append(j[near])

    stack: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(points)), None)]
    while stack:
        a, b = stack.pop()
        if len(a) == 0 or b is not None and len(b) == 0:
            continue
        if len(a) + (0 if b is None else len(b)) <= LEAF:
            direct(a, b)
            continue
        pool = a if b is None else np.concatenate((a, b))
        vantage = points[pool[len(pool) // 2]]
        da = np.bitwise_count(points[a] ^ vantage).astype(np.int64)
        far = np.bitwise_count(points[pool] ^ vantage)
        middle = int(np.median(far))
        inner, outer = a[da <= middle], a[da > middle]
        if b is None:
            if len(outer) == 0 or len(inner) == 0:
                # all in one ball of this radius: split by distance shells, or compare directly if there is one shell
                shells = np.unique(da)
                if len(shells) == 1:
                    direct(a, None)
                else:
                    cut = int(shells[len(shells) // 2])
                    low, high = a[da < cut], a[da >= cut]
                    stack += [(low, None), (high, None),
                              (a[(da < cut) & (da >= cut - max_bits)], a[(da >= cut) & (da < cut + max_bits)])]
                continue
            # pairs across the boundary: their distances to the vantage point differ by max_bits at most
            strip_in, strip_out = a[(da <= middle) & (da > middle - max_bits)], a[(da > middle) & (da <= middle + max_bits)]
            stack += [(inner, None), (outer, None), (strip_in, strip_out)]
            continue
        db = np.bitwise_count(points[b] ^ vantage).astype(np.int64)
        shells = np.unique(np.concatenate((da, db)))
        if len(shells) <= max_bits + 1:
            for at in range(0, len(a), 1 + (1 << 20) // len(b)):
                direct(a[at:at + 1 + (1 << 20) // len(b)], b)
            continue
        cut = int(shells[len(shells) // 2])
        stack += [(a[da < cut], b[db < cut]), (a[da >= cut], b[db >= cut]),
                  (a[(da < cut) & (da >= cut - max_bits)], b[(db >= cut) & (db < cut + max_bits)]),
                  (a[(da >= cut) & (da < cut + max_bits)], b[(db < cut) & (db >= cut - max_bits)])]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of n nodes."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before, label)  # hook whole trees
        label = label[label]
        if np.array_equal(before, label):
            return label


def _forest(batches, max_bits: int):
    """Edges (fingerprint, root) of each shard of a partition; rows come sorted by shard."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(keys: np.ndarray, fps: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        two = starts[sizes == 2]
        near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
        a, b = [fps[near]], [fps[near + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            points = fps[start:start + size]
            left, right = close_pairs(points, max_bits)
            if len(left):
                root = roots(size, left, right)
                linked = np.flatnonzero(root != np.arange(size))
                a.append(points[linked])
                b.append(points[root[linked]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], schema=schema)

    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = np.concatenate((keys, batch.column(0).to_numpy()))
        fps = np.concatenate((fps, batch.column(1).to_numpy().view(np.uint64)))
        whole = int(np.searchsorted(keys, keys[-1]))  # the last shard may go on in the next batch
        if whole:
            yield edges(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
    if len(keys):
        yield edges(keys, fps)


def link_forest(points: DataFrame, max_bits: int = MAX_BITS, slices: int = SLICES) -> DataFrame:
    """``(a, b)``: edges that connect exactly the distinct fingerprints ``fp`` within ``max_bits`` steps."""
    schema = pa.schema([("shard", pa.int64()), ("fp", pa.int64())])

    def spread(batches):
        for batch in small_batches(batches, 4096):
            fps = batch.column(0).to_numpy().view(np.uint64)
            keys = shard_keys(fps, max_bits, slices)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()),
                                              pa.array(np.repeat(fps.view(np.int64), keys.shape[1]))], schema=schema)

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (points.select("fp").mapInArrow(spread, "shard long, fp long")
             .repartition(parts, "shard").sortWithinPartitions("shard"))
    return dealt.mapInArrow(lambda b: _forest(b, max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; root: smallest node of its component.

    Alternating large-star and small-star steps on min-labels, until no edge changes.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if large:
            low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            pairs = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            low = down.groupBy("a").agg(F.min("b").alias("m"))
            pairs = (down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b"))))
        return pairs.where("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = checkpointed(edges)
    seen = state(edges)
    while True:
        edges = checkpointed(star(star(edges, True), False))
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``id_col, fingerprint, component_id``."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    points = prints.groupBy("fp").agg(F.min("id").alias("least"))
    found = components(link_forest(points, max_bits))
    roots_of = points.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    roots_of = written(roots_of, "simhash-roots")
    least = roots_of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots_of.join(least, "root").select("fp", "component_id")
    # A fingerprint may belong to a third of all rows; a sort-merge join lets Spark split its rows.
    return prints.join(named.hint("merge"), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
