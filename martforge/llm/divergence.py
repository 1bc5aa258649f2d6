"""Source divergence audit: which terms set the sources of a language apart, over the terms that are common enough.

Common terms are found by Iceberg prefix refinement.  Terms are cut to their first ``width`` bytes, and each document
counts each of its prefixes once; a prefix in fewer than ``min_docs`` documents of its language is dropped with every
term below it.  Only kept prefixes are extended, to twice the width, until none is as long as the width.  A term
shorter than the width is its own prefix, so what remains are complete terms with their exact document counts.

Each level is a pass over the texts.  Tasks sum prefixes before anything is shuffled and leave out those whose shorter
prefix was dropped.  They know the kept ones from a bitmap of fixed size (``SLOTS`` bits over hashes): a collision lets a
prefix through that its own exact count then drops, so results do not depend on it.

Distances are whole numbers: ``p = 1 + floor(1e9 (count + 5) / (N + 5 V))`` in decimals.  Distances between the
sources of a language are summed over blocks of terms, so nothing is emitted per term and pair of sources.

Defined cases: null text, language and source count as ``''``; rows that repeat an id are documents of their own;
a group without kept terms has distance 0 to another such group where the language keeps none (V = 0), and is
listed without ``term`` rows; a language with one source has no ``pair`` rows; an empty table gives an empty
result; terms and texts may be of any length; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import small_batches, written

MIN_DOCS = 30
FIRST_WIDTH = 6          # bytes of the first prefixes
SLOTS = 1 << 24          # bits of the bitmap of kept prefixes: 2 MB, the bound of what is sent to the tasks
SCALE, SMOOTH = 1_000_000_000, 5
TOP_TERMS = 50
HELD = 400_000           # prefixes or terms summed in a task before they are passed on
CELLS = 2_000_000        # numbers of a block of terms x sources

#: Bytes of terms: ASCII letters (A-Z lower-cased) and all bytes of other characters; the rest separates.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_SUMS = pa.schema([("lang", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("value", pa.int64())])


def words_of(text: str) -> list[bytes]:
    """The terms of a text, in order, repeats included."""
    return text.encode().translate(_TERM_BYTES).split()


def bitmap_of(prefixes: DataFrame, slots: int = SLOTS) -> bytes:
    """One bit for each hash of the ``lang, term`` rows."""
    slot = F.crc32(F.concat(F.col("lang").cast("binary"), F.col("term"))) % slots + 1
    found = prefixes.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()  # 4 KB each, slots / 32 768 rows
    size = 4096
    out = bytearray(max(slots // 8, size))
    for r in found:
        out[(r["bucket"] - 1) * size:r["bucket"] * size] = r["bits"]
    return bytes(out[:max(slots // 8, 1)])


def _known(bits: bytes, lang: str, prefix: bytes, slots: int) -> bool:
    slot = zlib.crc32(prefix, zlib.crc32(lang.encode())) % slots
    return bool(bits[slot >> 3] >> (slot & 7) & 1)


def _summed(docs: DataFrame, keys: list[str], add: Callable[[Counter, list[bytes]], None],
            keep: Callable[[str, bytes], bool], held: int) -> DataFrame:
    """``*keys, term, n``: counters over the words of each group's texts, summed where the texts are read.

    A group also has a row of the empty term (n = 0), so groups without terms are known.
    """
    schema = pa.schema([*[(k, pa.string()) for k in keys], ("term", pa.binary()), ("n", pa.int64())])

    def run(batches):
        sums: dict[tuple, Counter] = {}
        size = 0

        def out():
            for group, counter in sums.items():
                terms = [b"", *(t for t in counter if keep(group[0], t))]
                for at in range(0, len(terms), 50_000):
                    part = terms[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array([k] * len(part), pa.string()) for k in group], pa.array(part, pa.binary()),
                         pa.array([counter[t] for t in part], pa.int64())], schema=schema)

        for batch in small_batches(batches):
            groups = zip(*(batch.column(k).to_pylist() for k in keys))
            for group, text in zip(groups, batch.column("t")):
                counter = sums.get(group)
                if counter is None:
                    counter = sums[group] = Counter()
                size -= len(counter)
                add(counter, words_of(text.as_py()))
                size += len(counter)
                if size >= held:
                    yield from out()
                    sums, size = {}, 0
        yield from out()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (("text", "t"), *((k, k) for k in keys))]
    return docs.select(*named).mapInArrow(run, ", ".join(f"{k} string" for k in keys) + ", term binary, n long")


def prefix_counts(docs: DataFrame, width: int, parents: tuple[bytes, int] | None = None, held: int = HELD,
                  slots: int = SLOTS) -> DataFrame:
    """``lang, term, n``: in how many documents each prefix of ``width`` bytes (or shorter term) occurs, as partial sums.

    ``parents`` are the bitmap and the width of the prefixes kept before: only longer terms below them count.
    """
    bits, before = parents or (b"", 0)

    def add(counter, words):
        counter.update({w[:width] for w in words if len(w) >= before})

    def keep(lang, prefix):
        return not before or _known(bits, lang, prefix[:before], slots)

    return _summed(docs, ["lang"], add, keep, held)


def common_terms(docs: DataFrame, min_docs: int = MIN_DOCS, first_width: int = FIRST_WIDTH, held: int = HELD,
                 slots: int = SLOTS) -> DataFrame:
    """``lang, term, docs`` of the terms in at least ``min_docs`` documents of a language, level by level."""
    width, parents, kept = first_width, None, None
    while True:
        counts = prefix_counts(docs, width, parents, held, slots).where(F.octet_length("term") > 0)
        level = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs),
                        "prefixes")
        whole = level.where(F.octet_length("term") < width)
        kept = whole if kept is None else kept.unionByName(whole)
        longer = level.where(F.octet_length("term") == width)
        if longer.isEmpty():
            return kept
        parents = (bitmap_of(longer, slots), width)
        width *= 2


def term_counts(docs: DataFrame, kept: DataFrame, held: int = HELD, slots: int = SLOTS) -> DataFrame:
    """``lang, source, term, n``: occurrences of (at least) the kept terms, and the empty term of each group."""
    bits = bitmap_of(kept, slots)
    return _summed(docs, ["lang", "source"], lambda counter, words: counter.update(words),
                   lambda lang, term: _known(bits, lang, term, slots), held)


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH kept))`` in decimals; ``kept`` must not be 0."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = (wide(count) + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    under = wide(total) + wide(kept) * SMOOTH
    return F.lit(1).cast("long") + F.call_function("div", over, under)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences of every two sources over the batch's terms, language by language."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        rest, at, p = (batch.column(c) for c in ("rest", "at", "p"))
        by_lang: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            by_lang.setdefault(lang, []).append(i)
        for lang, members in by_lang.items():
            floor = np.asarray(rest[members[0]].values.to_numpy(zero_copy_only=False), dtype=np.int64)
            size = len(floor)
            if size < 2:
                continue
            step = max(1, CELLS // size)
            for start in range(0, len(members), step):
                part = members[start:start + step]
                block = np.tile(floor[:, None], (1, len(part)))
                for k, i in enumerate(part):
                    block[at[i].values.to_numpy(zero_copy_only=False), k] = p[i].values.to_numpy(zero_copy_only=False)
                for i in range(size - 1):
                    value = np.abs(block[i + 1:] - block[i]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(value), pa.string()), pa.array(np.full(len(value), i, np.int32)),
                        pa.array(np.arange(i + 1, size, dtype=np.int32)), pa.array(value)], schema=_SUMS)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, first_width: int = FIRST_WIDTH) -> DataFrame:
    """``lang, source, part, item, value, rank``: ``pair`` rows (other sources) and ``term`` rows (``top`` terms)."""
    kept = written(common_terms(docs, min_docs, first_width), "kept")
    # occurrences of kept terms by language and source; the empty term stands for its group
    sums = written(term_counts(docs, kept).groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "terms")
    cells = written(sums.join(kept.select("lang", "term"), ["lang", "term"], "left_semi"), "cells")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    of_lang = Window.partitionBy("lang")
    groups = written(
        sums.where(F.octet_length("term") == 0).select("lang", "source")
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(sizes, "lang", "left").fillna(0, ["total", "kept"])
        .withColumn("lang_total", F.sum("total").over(of_lang))
        .withColumn("at", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int")), "groups")

    known = cells.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    terms = known.groupBy("lang", "term").agg(  # one entry a source of the language at most
        F.sum("n").alias("lang_n"), F.first("lang_total").alias("lang_total"), F.first("kept").alias("kept"),
        F.collect_list(F.struct("source", "at", "p")).alias("found"))
    terms = written(terms.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))), "shares")

    # a group's p of a term that it does not hold, as one array a language, in the order of its sources
    rest = (groups.where("kept > 0").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(
        "at", share(F.lit(0), F.col("total"), F.col("kept")).alias("p")))).alias("rest")))
    apart = (terms.select("lang", "found.at", "found.p").join(rest.select("lang", F.col("rest.p").alias("rest")), "lang")
            .select("lang", "rest", "at", "p")
            .mapInArrow(_block_sums, "lang string, i int, j int, value long")
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
    both = apart.unionByName(apart.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    others = groups.select(F.col("lang").alias("__lang"), F.col("source").alias("item"), F.col("at").alias("j"))
    pairs = (groups.select("lang", "source", F.col("at").alias("i"))
             .join(others, (F.col("lang") == F.col("__lang")) & (F.col("i") != F.col("j")))  # the result's own rows
             .drop("__lang").join(both, ["lang", "i", "j"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    lone = (terms.select("lang", "term", "q", F.explode("found").alias("f")).where(F.col("f.p") > F.col("q"))
            .select("lang", F.col("f.source").alias("source"), F.lit("term").alias("part"),
                    F.decode("term", "UTF-8").alias("item"), (F.col("f.p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return pairs.unionByName(lone)
