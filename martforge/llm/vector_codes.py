"""Vector code compression: product codes of integer vectors, codebooks trained with LAESA pivots.

Components become ``floor(1024 x)``; a vector is cut into ``PARTS`` consecutive parts, and each part position has a
codebook of at most ``ENTRIES`` entries.  Each round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces entries by the componentwise floor of their parts' mean.

LAESA: a few entries of the first codebook, far from each other, are the fixed pivots of a part position.  The
distance of every part to every pivot is computed once and stored with the row.  In a round only the distances from
the pivots to the entries are new; ``|d(part, pivot) - d(pivot, entry)|`` bounds the distance of part and entry from
below.  The entry with the least bound is evaluated first; parts that agree on it form a block, whose other
entries are evaluated in ascending order of their bounds, and those whose bound exceeds all that the block has
found are never evaluated.  Bounds are lowered by more than their rounding error, and evaluations are exact whole
numbers, so pruning never changes a result.

A round is one pass over the stored rows.  Tasks return a count and sums per entry (``PARTS * ENTRIES`` of them at
most), so the driver holds codebooks only, whatever the input's size.

Defined cases: rows with a null vector, or one with null or non-finite components, are dropped, and so are vectors
of another length than the first kept one's; fewer rows than entries make fewer entries; rows that repeat an id are
rows of their own (ordered by their vectors where they may be first entries), null ids come last; lengths that
four does not divide give parts that differ by one; whole numbers beyond 2^53 count as 2^53 and errors beyond
2^63 - 1 as that; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
PIVOTS = 6
BLOCK = 256              # parts of a block
CHUNK = 32               # entries evaluated at a time
LARGEST = 1 << 53        # whole numbers are held in 64 bits
_EXACT = 1 << 22         # up to here 64-bit floats hold every sum of squares of up to 64 differences exactly


@dataclass(frozen=True)
class Codebooks:
    """``entries``: per part an array (entries x components); ``pivots``: likewise, fixed at the beginning."""

    entries: tuple[np.ndarray, ...]
    pivots: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        text = ",".join(str(int(x)) for book in self.entries for x in book.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def cuts(length: int, parts: int = PARTS) -> list[slice]:
    at = [length * p // parts for p in range(parts + 1)]
    return [slice(a, b) for a, b in zip(at, at[1:])]


def choose_pivots(book: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: first the one farthest from entry 0, then always the one farthest from all."""
    points = book.astype(np.float64)
    far = ((points - points[0]) ** 2).sum(axis=1)
    chosen = []
    for _ in range(min(pivots, len(points))):
        chosen.append(int(far.argmax()))
        near = ((points - points[chosen[-1]]) ** 2).sum(axis=1)
        far = near if len(chosen) == 1 else np.minimum(far, near)
    return book[chosen]


def pivot_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rounded distances of every point to every pivot, a row a point."""
    wide = points.astype(np.float64)
    return np.stack([np.sqrt(((wide - p) ** 2).sum(axis=1)) for p in pivots.astype(np.float64)], axis=1).astype(np.float32)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x entries): floats where they hold the numbers, whole numbers beyond."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if largest <= _EXACT and points.shape[1] <= 64:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)
    p, e = points.astype(object), entries.astype(object)
    return np.array([[sum((a - b) ** 2 for a, b in zip(x, y)) for y in e] for x in p], dtype=object).reshape(len(p), len(e))


def assign(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray,
           block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of every point, its squared distance, and how many pairs were evaluated."""
    n = len(points)
    code, best = np.zeros(n, np.int64), np.zeros(n, object)
    from_pivots = pivot_distances(entries, pivots)
    bound = np.zeros((n, len(entries)), np.float32)
    for k in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, k, None] - from_pivots[None, :, k]), out=bound)
    # both distances are rounded to 24 bits: lower the bound by more than that
    slack = (to_pivots.max(axis=1, initial=0) + from_pivots.max(initial=0)) * np.float32(1e-6)
    seed = bound.argmin(axis=1)
    order, evaluated = np.argsort(seed, kind="stable"), 0
    for start in range(0, n, block):
        rows = order[start:start + block]
        mine = points[rows]
        least = (bound[rows] - slack[rows, None]).min(axis=0)
        first = np.unique(seed[rows])
        rest = np.argsort(least, kind="stable")
        queue = np.concatenate([first, rest[~np.isin(rest, first)]])
        found, index = None, None
        for at in range(0, len(queue), CHUNK):
            chunk = queue[at:at + CHUNK]
            if found is not None:
                reach = np.sqrt(float(found.max())) * (1 + 1e-9)
                chunk = chunk[least[chunk] <= reach]
                if not len(chunk):
                    if at >= len(first):
                        break  # bounds only rise from here on
                    continue
            chunk = np.sort(chunk)
            d = squared(mine, entries[chunk])
            evaluated += d.size
            pick = d.argmin(axis=1)
            near, which = d[np.arange(len(rows)), pick], chunk[pick]
            if found is None:
                found, index = near, which
            else:
                better = (near < found) | ((near == found) & (which < index))
                found, index = np.where(better, near, found), np.where(better, which, index)
        code[rows], best[rows] = index, found
    return code, best, evaluated


def _whole(vectors: pa.Array, length: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(np.clip(flat, -LARGEST, LARGEST) * SCALE)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64).reshape(-1, length)


def _packed(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def clean_vectors(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector holds finite numbers only."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return df.where(x.isNotNull() & F.coalesce(finite, F.lit(False)))


def _first_books(rows: DataFrame, entries: int, parts: int) -> tuple[int, Codebooks] | None:
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(1).collect()
    if not first:
        return None
    length = len(first[0]["vec"])
    same = rows.where(F.size("vec") == length).orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    whole = _whole(pa.array([r["vec"] for r in same], pa.list_(pa.float64())), length) if length else \
        np.zeros((len(same), 0), np.int64)
    books = tuple(whole[:, c] for c in cuts(length, parts))
    return length, Codebooks(books, tuple(choose_pivots(b) for b in books))


def prepared(rows: DataFrame, length: int, books: Codebooks) -> DataFrame:
    """``id, label, whole, dist``: whole numbers and all pivot distances as bytes, computed once and stored."""
    pieces, pivots = cuts(length, len(books.pivots)), books.pivots

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            whole = _whole(batch.column("vec"), length) if length else np.zeros((n, 0), np.int64)
            dist = np.concatenate([pivot_distances(whole[:, c], p) for c, p in zip(pieces, pivots)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), _packed(whole), _packed(dist)],
                                             ["id", "label", "whole", "dist"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return written(rows.where(F.size("vec") == length).mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, whole binary, dist binary"), "vectors")


def _assigned(batch: pa.RecordBatch, length: int, books: Codebooks):
    """Per part: slice, whole numbers, codes, squared distances."""
    whole = _unpacked(batch.column("whole"), np.int64, length)
    widths = [len(p) for p in books.pivots]
    dist = _unpacked(batch.column("dist"), np.float32, sum(widths))
    at = 0
    for piece, entries, pivots in zip(cuts(length, len(books.entries)), books.entries, books.pivots):
        code, best, _ = assign(whole[:, piece], dist[:, at:at + len(pivots)], entries, pivots)
        at += len(pivots)
        yield whole[:, piece], code, best


def train_round(stored: DataFrame, length: int, books: Codebooks) -> Codebooks:
    """The codebooks after one round of assignment and replacement."""
    def run(batches):
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        sums = [np.zeros(e.shape, object) for e in books.entries]
        for batch in batches:
            for part, (points, code, _) in enumerate(_assigned(batch, length, books)):
                counts[part] += np.bincount(code, minlength=len(counts[part]))
                if np.abs(points).max(initial=0) <= _EXACT:  # 64-bit sums of a batch cannot overflow
                    exact = np.zeros(sums[part].shape, np.int64)
                    np.add.at(exact, code, points)
                    sums[part] += exact.astype(object)
                else:
                    np.add.at(sums[part], code, points.astype(object))
        out = [(part, i, pos, int(c), int(s) >> 32, int(s) & 0xFFFFFFFF)
               for part, book in enumerate(sums) for i, c in enumerate(counts[part]) if c
               for pos, s in enumerate(book[i])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["part", "entry", "pos", "n", "hi", "lo"])

    # sums travel as two halves, so adding them up in 64 bits cannot overflow
    totals = (stored.select("whole", "dist").mapInArrow(run, "part long, entry long, pos long, n long, hi long, lo long")
              .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")))
    entries = [e.copy() for e in books.entries]
    for r in totals.collect():  # an entry's component each: at most parts x entries x components of a part
        entries[r["part"]][r["entry"], r["pos"]] = ((r["hi"] << 32) + r["lo"]) // r["n"]
    return Codebooks(tuple(entries), books.pivots)


def encoded(stored: DataFrame, length: int, books: Codebooks) -> DataFrame:
    """``id, label, code, error``: two hexadecimal digits a part, squared distances summed."""
    def run(batches):
        for batch in batches:
            text, error = np.array([""] * batch.num_rows, object), np.zeros(batch.num_rows, object)
            for _, code, best in _assigned(batch, length, books):
                text = text + np.array([f"{c:02x}" for c in code], object)
                error = error + best
            error = [min(int(e), (1 << 63) - 1) for e in error]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(text, pa.string()),
                                              pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in stored.schema}
    return stored.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """``id, label, code, error`` of every kept row (a stored table), and the final codebooks."""
    rows = clean_vectors(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                                        F.col(vec_col).alias("vec")), "vec")
    begun = _first_books(rows, entries, parts)
    if begun is None:
        return rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    length, books = begun
    stored = prepared(rows, length, books)
    for _ in range(rounds):
        books = train_round(stored, length, books)
    return written(encoded(stored, length, books), "codes"), books


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``approx``: the vector that each code stands for, in the scale of the input."""
    tables = [np.round(b.astype(np.float64) + 0.5, 6) / SCALE for b in books.entries]  # the middle of what floor joins

    def run(batches):
        for batch in batches:
            text = batch.column("code").to_pylist()
            found = [np.concatenate([t[int(c[2 * p:2 * p + 2], 16)] for p, t in enumerate(tables)]) for c in text]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f.tolist() for f in found], pa.list_(pa.float64()))],
                                             [*batch.schema.names, "approx"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{kinds}, approx array<double>")


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the errors of equal labels summed (null labels are equal)."""
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
