"""A corpus pipeline: language filter, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and hands it to the next stage.  All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import langid, mixing, packing, secret_scan, simhash
from tallyhouse.llm.common import read_table, scratch, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    return langid.accepted(docs, langid.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.MAX_BITS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# Training, fingerprints and tokens are beyond SQL; tests/llm holds a run
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with scratch(spark):                    # what the stages wrote for each other goes in the end
        for name, stage in STAGES:
            with scratch(spark):            # what a stage wrote for itself, as soon as it is done
                docs = stored(stage(spark, docs, sf_dir), name)
    return docs
