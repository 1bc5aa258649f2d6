"""Document fingerprints: a threshold-scaled sketch of each text's shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the document's, the
sketch of a union is the union of the sketches, and the share of a small document that a far larger one holds can
be estimated as well as the likeness of two equal ones.  A sketch of a smaller fraction is cut out of one of a larger.

Shingles are ``words`` words (runs outside ``[\\x20\\x09-\\x0D]``, as written) joined by one space; a text of fewer
words is one shingle.  A hash is the first 16 hexadecimal digits of the shingle's MD5, kept as text: digits order as
numbers do.  A text with words, none of whose hashes lies below the threshold, keeps its smallest hash, so only
texts without words have an empty sketch.

Everything here is DataFrame code.  ``with_next`` gives each row its successor in the order of the ids without one
task seeing all rows: ids are cut into ranges at sampled bounds (which decide the balance, never the result), the
first row of each range is also dealt to the range before it, and a window runs per range.

Defined cases: a null text counts as empty; rows that repeat an id follow each other in the order of their texts
(in one range, whose sort spills); null ids come first; one row is its own successor; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import bounded_sample

WORDS = 5
FRACTION = 0.25
RANGE_ROWS = 100      # rows wanted in a range of ids
MAX_RANGES = 65_536   # bounds what the driver reads and the broadcast of the ranges' first ids
SAMPLE = 10           # sampled ids a range


def _threshold(fraction: float) -> str:
    """The hash digits that bound ``fraction`` of the range from above (a multiple of 1/65536)."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    return "g" if fraction == 1 else f"{max(1, round(fraction * 65_536)):04x}"


def normalised(text: Column) -> Column:
    """The words of a text, joined by one space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def shingles(words_joined: Column, words: int = WORDS) -> Column:
    """Every run of ``words`` words, in order, repeats included; empty for fewer words.

    One pass of a pattern that looks ahead from each word, so the array of words is never built or sliced.
    """
    pattern = rf"(?<![^ ])(?=([^ ]++(?: [^ ]++){{{words - 1}}}))"
    return F.regexp_extract_all(words_joined, F.lit(pattern), F.lit(1))


def retained(hashes: Column, fraction: float = FRACTION) -> Column:
    """The sketch of shingle hashes: sorted, without repeats."""
    below = F.filter(hashes, lambda h: h < F.lit(_threshold(fraction)))
    kept = F.when(F.size(below) > 0, below).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(below)
    return F.sort_array(F.array_distinct(F.transform(kept, lambda h: F.substring(h, 1, 16))))


def with_sketch(df: DataFrame, text_col: str, out: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """``df`` with the sketch of ``text_col`` (array of hash texts) as column ``out``."""
    # a column for each step: a function over an array computes what it refers to anew for each element
    joined, found = F.col("__joined"), F.col("__shingles")
    whole = F.when(F.size(found) == 0, F.array_remove(F.array(joined), "")).otherwise(found)
    return (df.withColumn("__joined", normalised(F.col(text_col))).withColumn("__shingles", shingles(joined, words))
            .withColumn("__hashes", F.transform(whole, lambda x: F.md5(x)))
            .withColumn(out, retained(F.col("__hashes"), fraction)).drop("__joined", "__shingles", "__hashes"))


def fingerprint(sketch: Column) -> Column:
    """A sketch as one text."""
    return F.array_join(sketch, " ")


def merged(df: DataFrame, key: str, sketch_col: str) -> DataFrame:
    """``key, hash``: the sketch of each key's documents together, a row a hash (a key's sketch may be large)."""
    return df.select(F.col(key), F.explode(sketch_col).alias("hash")).distinct()


def rescaled(sketch: Column, fraction: float) -> Column:
    """The sketch of a smaller ``fraction`` out of a larger one's."""
    below = F.filter(sketch, lambda h: h < F.lit(_threshold(fraction)))
    return F.when(F.size(below) > 0, below).otherwise(F.slice(sketch, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two documents; 1 for two empty sketches."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    either = F.size(a) + F.size(b)
    return F.when(either == 0, 1.0).otherwise(both / F.nullif(either.cast("double") - both, F.lit(0.0)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds; 1 where ``a`` has none."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.size(a) == 0, 1.0).otherwise(both / F.nullif(F.size(a).cast("double"), F.lit(0.0)))


def _range_of(ids: DataFrame, id_col: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` an id reaches: counted among every k-th bound, then within one block."""
    kind = ids.schema[id_col].dataType
    block = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i:i + block] for i in range(0, len(bounds), block)]
    # one foldable literal each, however many bounds
    heads = F.from_json(F.lit(json.dumps([b[0] for b in blocks])), T.ArrayType(kind))
    each = F.from_json(F.lit(json.dumps(blocks)), T.ArrayType(T.ArrayType(kind)))
    reached = F.size(F.filter(heads, lambda b: b <= F.col(id_col)))
    inside = F.size(F.filter(F.element_at(each, F.greatest(reached, F.lit(1))), lambda b: b <= F.col(id_col)))
    return F.when(F.col(id_col).isNull() | (reached == 0), 0).otherwise((reached - 1) * block + inside)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``__id, __text, __range, __guest`` of every row, dealt out by range; ``next_of`` reads the successors.

    Each range ends with a guest: the row that follows its last one (the very first row after the very last).
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    if not isinstance(rows.schema["__id"].dataType, T.IntegralType | T.StringType):
        raise TypeError(f"{id_col} must hold whole numbers or text")
    ids = rows.select("__id")
    ranges = min(MAX_RANGES, -(-ids.count() // range_rows))
    bounds: list = []
    if ranges > 1:
        sample = bounded_sample(ids.where(F.col("__id").isNotNull()), F.col("__id"), SAMPLE * ranges)
        known = [r[0] for r in sample.distinct().orderBy("__id").collect()]
        bounds = sorted({known[len(known) * i // ranges] for i in range(1, ranges)}) if known else []
    at = _range_of(ids, "__id", bounds) if bounds else F.lit(0)
    firsts = sorted(tuple(r) for r in ids.groupBy(at.alias("r")).agg(
        F.min_by(F.struct("__id"), F.struct("__id"))["__id"].alias("first")).collect())
    spark = docs.sparkSession
    kind = T.StructType([T.StructField("__first", rows.schema["__id"].dataType), T.StructField("__before", T.IntegerType())])
    guests = spark.createDataFrame([(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], kind)
    dealt = (rows.withColumn("__own", at.cast("int"))
             .join(F.broadcast(guests), F.col("__id").eqNullSafe(F.col("__first")), "left")  # a row a range at most
             .withColumn("__range", F.explode(F.when(F.col("__before").isNull(), F.array(F.struct(
                 F.col("__own").alias("r"), F.lit(False).alias("g")))).otherwise(F.array(
                     F.struct(F.col("__own").alias("r"), F.lit(False).alias("g")),
                     F.struct(F.col("__before").alias("r"), F.lit(True).alias("g")))))))
    return dealt.select("__id", "__text", F.col("__range.r").alias("__range"), F.col("__range.g").alias("__guest")
                        ).repartition("__range")


def next_of(dealt: DataFrame, *columns: str) -> DataFrame:
    """The rows of ``with_next`` without guests, with ``__next_<column>`` of the row that follows."""
    order = Window.partitionBy("__range").orderBy("__guest", "__id", "__text")
    for c in columns:
        dealt = dealt.withColumn(f"__next_{c.strip('_')}", F.lead(c).over(order))
    return dealt.where(~F.col("__guest"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                          fraction: float = FRACTION) -> DataFrame:
    """One row per document: its sketch beside that of its edited text and that of the next document.

    The edited text has the last half of the code points replaced by as many from the beginning of the next one.
    """
    dealt = with_sketch(with_next(docs, id_col, text_col), "__text", "__own", words, fraction)
    n = F.char_length("__text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("__text", F.lit(1), n - half), F.substring("__next_text", F.lit(1), half))
    pairs = next_of(dealt, "__text", "__own").withColumn("__edited", edited)
    done = with_sketch(pairs, "__edited", "__changed", words, fraction)
    own, changed, following = F.col("__own"), F.col("__changed"), F.col("__next_own")
    return done.select(
        F.col("__id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"), fingerprint(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"),
        containment(own, changed).alias("held_edited"), containment(own, following).alias("held_next"))
