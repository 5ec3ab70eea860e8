"""Training-text pipeline: each stage is one operator over all that the stage before kept.

Documents with poor quality go, one document of each group of near-duplicates stays, documents
that hold a test item go, secrets are replaced in the texts, what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import decontamination, quality_rules, secret_scan, sentencepieces, simhash
from lakeops.llm.common import table, written
from lakeops.llm.queries import PIECE_MODEL

#: Fingerprints, trained weights and pieces have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded_digests(docs, PIECE_MODEL)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate),
          ("secret_scan", redact_secrets), ("sentencepiece_encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
