"""From raw documents to packed training sequences, stage by stage.

Each stage is called with (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from namepulse.llm import decontamination, packing, quality, secrets, simhash
from namepulse.llm.shared import kept, table
from namepulse.llm.tokens import public_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned list keep."""
    return quality.filtered(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each class of near-duplicates."""
    return simhash.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with an item of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text."""
    clean = secrets.redacted(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# The learned list, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents`."""
    return run(spark, sf_dir)
