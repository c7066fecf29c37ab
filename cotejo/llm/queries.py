"""Queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.llm import (
    decontam,
    fuzzyhash,
    html_extract,
    jaccard,
    license,
    packing,
    pii,
    prefixtrie,
    quality,
    runs,
    sharding,
    statements,
    tokencount,
    warc,
)
from cotejo.llm.common import read


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_wrapper_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(read(spark, folder, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(read(spark, folder, "documents"))


def op3_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read(spark, folder, "documents"))


def op4_sentence_rule_licences(spark: SparkSession, folder: str) -> DataFrame:
    return license.licences(read(spark, folder, "documents"))


def op5_disguised_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(read(spark, folder, "documents"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_file())


def op7_longest_match_counts(spark: SparkSession, folder: str) -> DataFrame:
    initial, following = tokencount.whole_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    return tokencount.token_counts(read(spark, folder, "documents"), initial, following)


def op8_revisit_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read(spark, folder, "pages"))


def op9_balanced_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"), 16)


def op10_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_report(read(spark, folder, "documents"))


def op12_piecewise_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzyhash.edited_report(read(spark, folder, "documents"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.trie(read(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_wrapper_extraction,
        op2_ngram_jaccard_join,
        op3_compression_quality,
        op4_sentence_rule_licences,
        op5_disguised_personal_data,
        op6_best_fit_packing,
        op7_longest_match_counts,
        op8_revisit_archives,
        op9_balanced_label_propagation,
        op10_spaced_seed_decontamination,
        op11_periodic_runs,
        op12_piecewise_fingerprints,
        op13_conversation_trie,
    )
}
ORACLES: dict[str, str] = {
    "op8_revisit_archives": statements.REVISITS,
    "op13_conversation_trie": statements.TRIE,
}
