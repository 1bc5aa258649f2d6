"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import (bpe, decontam, divergence, exact_dedup, langid, line_dedup, sharding, simhash, sketch,
                           token_files, toxicity, vector_codes, warc)
from martforge.llm.common import new_path, read


def _remainder(parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read(spark, sf_dir, "documents"), "word_bpe_49k.json")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(_remainder(4) != 2)
    grammar = toxicity.train(toxicity.training_rows(docs, labels))
    score = F.col(toxicity.SCORE)
    return toxicity.scored(docs.select("doc_id", "text"), grammar).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), score.alias("score"),
        F.when(score >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path, "byte_bpe_50k.json", end_id=2)
    return token_files.document_starts(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identified(docs, _remainder(5) != 0).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), F.col("__lang.lang").alias("lang_pred"),
        F.col("__lang.score").alias("score"), F.col("__lang.rejected").alias("rejected"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(read(spark, sf_dir, "documents"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), path, min_bytes=0)
    back = warc.read_warc(spark, path)
    page = lambda c: F.regexp_extract(c, r"urn:x-page:(-?\d+)", 1).try_cast("long")
    revisit = F.col("record_type") == "revisit"
    return back.select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.col("stated_digest").alias("payload_digest"), "record_type",
        F.when(revisit, page("refers_to")).alias("refers_to"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(books.sha256() if books else "").alias("codebooks_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint_documents(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_sharding": op8_sharding,
    "op9_line_dedup": op9_line_dedup,
    "op10_warc": op10_warc,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_divergence": op12_source_divergence,
    "op13_fingerprints": op13_fingerprints,
}
