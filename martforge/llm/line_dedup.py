"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  Keys
of at least ``min_chars`` code points found in at least ``min_docs`` documents lose
their lines everywhere but in the largest id that holds them.

The documents are taken in batches of descending id.  The state is a set of sorted
runs of ``(key hash, documents seen, largest id)``, in levels like a log-structured
merge tree: each batch merge-anti-joins the runs' *settled* keys (seen in ``min_docs``
documents already; since ids descend, their owner cannot change), adds what is left
as its own run, and when a level holds ``fan_out`` runs, they are compacted into one
run of the next level.  A line found in a third of all documents therefore stops
growing the state after the first batch.  The last compaction gives every key's
total.  All runs are dealt into the same buckets by key, a sorted file each, so a stored run
meets a batch or another run bucket by bucket and is never exchanged again.

Hashes are 128 bits (XXH3), so different lines do not meet at any real size.  Texts
are read twice and shuffled once, to meet their lists of lines to drop; all
between is 16-byte hashes.  Counting is pre-aggregated, the lookup of frequent lines
is salted by document.

Defined cases: null and empty texts are one empty line and stay as they are (null
becomes the empty text); short lines are never dropped; a repeated line within
one document counts as one document, and all its copies stay or go together; rows
with a null id never own a line, and never lose one; repeated ids count as one
document; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import ASCII_WS, bucketed, map_batches, small_batches, written

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4    # batches of descending id
FAN_OUT = 2    # runs of a level before they are compacted into the next
SALTS = 16     # pieces of a frequent line's documents


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short."""
    key = line.strip(ASCII_WS).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(id, key)``: the distinct long keys of each document."""
    def run(batch: pa.RecordBatch) -> dict:
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {h for line in text.split(b"\n") if (h := line_hash(line, min_chars))}
            ids += [doc] * len(found)
            keys += sorted(found)
        return {"id": ids, "key": keys}
    src = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(src, run, "id long, key binary", pa.schema([("id", pa.int64()), ("key", pa.binary())]))


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """The totals of two runs: a merge join, bucket by bucket.  (A union of bucketed scans would be aggregated without
    an exchange too, but Spark 4.1 lays such scans end to end instead of bucket to bucket.)"""
    b = b.select("key", F.col("n").alias("n2"), F.col("owner").alias("owner2"))
    return a.join(b.hint("merge"), "key", "full_outer").select(
        "key", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
        F.greatest("owner", "owner2").alias("owner"))


def _totals(runs: list[DataFrame], tag: str) -> DataFrame:
    """The totals of several runs, two at a time; all but the last result are stored runs again."""
    total = runs[0]
    for i, r in enumerate(runs[1:], 1):
        total = _merged(total, r)
        if i < len(runs) - 1:
            total = bucketed(total, tag, "key")
    return total


def _unsettled(own: DataFrame, runs: list[DataFrame], min_docs: int) -> DataFrame:
    """The rows of a batch whose keys no run has settled."""
    for r in runs:
        own = own.join(r.where(F.col("n") >= min_docs).select("key").hint("merge"), "key", "left_anti")
    return own


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT) -> DataFrame:
    """``(key, n, owner)`` of the keys in at least ``min_docs`` documents.

    ``lines``: ``(batch, id, key)`` with batches numbered from the largest ids down.  ``n`` counts
    the documents up to the batch in which the key settled.
    """
    levels: dict[int, list[DataFrame]] = {}
    batches = sorted(r[0] for r in lines.select("batch").distinct().collect())
    for b in batches:
        own = lines.where(F.col("batch") == b).groupBy("key").agg(
            F.count_distinct("id").alias("n"), F.max("id").alias("owner"))
        if levels:
            own = _unsettled(own, [r for runs in levels.values() for r in runs], min_docs)
        runs, level = [bucketed(own, f"lines-run{b}", "key")], 0
        while len(levels.get(level, [])) + len(runs) >= fan_out:
            tag = f"lines-level{level + 1}"
            runs, level = [bucketed(_totals(levels.pop(level, []) + runs, tag), tag, "key")], level + 1
        levels.setdefault(level, []).extend(runs)
    every = [r for runs in levels.values() for r in runs]
    if not every:
        return lines.sparkSession.createDataFrame([], "key binary, n long, owner long")
    return _totals(every, "lines-last").where(F.col("n") >= min_docs)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """``docs`` with the kept lines as text, and ``_n_lines`` (before) and ``_n_dropped``."""
    hashes = _hashes(docs, id_col, text_col, min_chars)
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [i / batches for i in range(1, batches)], 10_000)
                       ).first()[0] or []
    batch = F.lit(0)
    for cut in sorted(set(cuts)):
        batch = batch + (F.col("id") <= F.lit(cut)).cast("int")
    lines = written(hashes.withColumn("batch", batch), "lines", "batch")
    frequent = frequent_lines(lines, min_docs, fan_out)
    frequent = frequent.select("key", "owner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    lost = (lines.select("id", "key", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
            .join(frequent, ["key", "salt"]).where(F.col("id") != F.col("owner"))
            .groupBy("id").agg(F.collect_set("key").alias("keys")))
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    names = [f"c{i}" for i in range(len(rest))]
    src = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"),
                      *[F.col(f"`{c}`").alias(n) for c, n in zip(rest, names)])
    joined = src.join(lost, src["_doc"].cast("long") == lost["id"], "left").drop("id")
    fields = {f.name: f for f in joined.schema.fields}
    out = f"_doc {fields['_doc'].dataType.simpleString()}, _text binary, _n_lines long, _n_dropped long" + "".join(
        f", {n} {fields[n].dataType.simpleString()}" for n in names)

    def run(parts):
        for part in parts:
            for b in small_batches([part]):
                texts, totals, dropped = [], [], []
                for text, keys in zip(b.column("_text").to_pylist(), b.column("keys").to_pylist()):
                    have = text.split(b"\n")
                    totals.append(len(have))
                    if keys:
                        gone = set(keys)
                        kept = [x for x in have if line_hash(x, min_chars) not in gone]
                        dropped.append(len(have) - len(kept))
                        text = b"\n".join(kept)
                    else:
                        dropped.append(0)
                    texts.append(text)
                columns = [b.column("_doc"), pa.array(texts, pa.binary()), pa.array(totals, pa.int64()),
                           pa.array(dropped, pa.int64()), *[b.column(n) for n in names]]
                yield pa.RecordBatch.from_arrays(columns, ["_doc", "_text", "_n_lines", "_n_dropped", *names])

    done = joined.mapInArrow(run, out)
    back = {id_col: F.col("_doc").alias(id_col), text_col: F.col("_text").cast("string").alias(text_col)}
    back |= {c: F.col(n).alias(c) for c, n in zip(rest, names)}
    return done.select(*[back[c] for c in docs.columns], "_n_lines", "_n_dropped")
