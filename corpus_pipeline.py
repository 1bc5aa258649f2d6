"""A corpus in five stages: filter toxic documents, drop repeated lines, keep one of near copies, drop documents that
hold benchmark items, encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept.  All but the last return
the columns of ``documents``; each stage's result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import bpe, decontam, line_dedup, simhash, toxicity
from martforge.llm.common import drop_path, new_path, read

TOXIC_SCORE = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC_SCORE``; the grammar learns from the rows that op4 learns from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    grammar = toxicity.train(toxicity.training_rows(docs, read(spark, sf_dir, "labels").where(fold != 2)))
    return toxicity.scored(docs, grammar).where(F.col(toxicity.SCORE) < TOXIC_SCORE).drop(toxicity.SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another document keeps; ``n_chars`` follows the text."""
    done = line_dedup.dedup_lines(docs).drop("_n_lines", "_n_dropped")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component (rows that repeat an id stay or go together)."""
    found = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept"))
            .distinct())
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    return bpe.digest_documents(docs, "word_bpe_49k.json")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL cannot express the toxicity, SimHash and BPE stages; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            drop_path(spark, before)  # the next stage's input is written; nothing reads this one any more
        before = path
    return docs
