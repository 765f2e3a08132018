"""One query per operator of this subpackage, over its whole table, and the
DuckDB statements for those that SQL can express.

Packing, the learnt models, XXH64 fingerprints and signatures, and spans with
look-around are beyond DuckDB's SQL; tests/llm holds these against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (covertree, crosstok, langid, licenses, mixing, packing, periodic, quality, secret_scan,
                            sharding, simhash, spotsigs, warc)
from tallyhouse.llm.common import read_table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score", "alternatives")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(read_table(spark, sf_dir, "documents"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), simhash.SHINGLE, simhash.MAX_BITS)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.measures(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.scan(read_table(spark, sf_dir, "documents"), edit=periodic.planted))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_license_scans, op3_secret_scans, op4_document_fingerprints, op5_simhash_near_dedup,
        op6_language_id, op7_mixing, op8_quality_classifier, op9_warc, op10_embedding_near_dedup,
        op11_cross_tokenizer_alignment, op12_periodic_runs, op13_sharding)}


def all_sql() -> dict[str, str]:
    return {"op7_mixing": mixing.ORACLE_SQL, "op9_warc": warc.ORACLE_SQL,
            "op10_embedding_near_dedup": covertree.ORACLE_SQL}
