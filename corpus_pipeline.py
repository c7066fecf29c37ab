"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cotejo.llm import decontam, jaccard, packing, pii, quality
from cotejo.llm.common import read, stage
from cotejo.llm.queries import tokenizer_file


# Settings of the run: texts go to Python workers a few MB at a time, and a stage's table is written
# in small row groups, so that neither side holds many long texts. Results do not depend on them.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "parquet.block.size": str(16 << 20),
}


def small_memory(spark: SparkSession) -> None:
    """Set what the stages are written for. The tables that they return are written by the caller,
    so the settings stay."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text passes the base rules and the compression bands."""
    small_memory(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of similar documents."""
    small_memory(spark)
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_memory(spark)
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    small_memory(spark)
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4096 tokens."""
    small_memory(spark)
    return packing.pack(docs, tokenizer_file(), lean=True)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]
# Compression, similarity joins and tokenizers are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
