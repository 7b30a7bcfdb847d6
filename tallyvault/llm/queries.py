"""The operators of this subpackage as named queries over the benchmark tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvault.llm import (
    chaining,
    context_tree,
    decontamination,
    divergence,
    extraction,
    language,
    minhash,
    ngram_join,
    packing,
    quality,
    resampling,
    suffix_dedup,
    toxicity,
)
from tallyvault.llm.shared import bound_batches

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """The remainder that deals documents to folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(_table(spark, sf_dir, "documents"), fold(3) == 1)
    return found.withColumn("n_spans", F.size("spans").cast("long")).drop("spans", "extra")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)  # it holds the words of two documents beside each other
    return chaining.without_passages(_table(spark, sf_dir, "documents")).drop("text", "extra")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).drop("ids")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold(5) == 0)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(_table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("extra")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(_table(spark, sf_dir, "documents"), fold(7) == 2)


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = (
    op1_language_id,
    op2_quality_rules,
    op3_html_extraction,
    op4_substring_dedup,
    op5_best_fit_packing,
    op6_suffix_array_dedup,
    op7_toxicity,
    op8_ngram_jaccard_join,
    op9_benchmark_decontamination,
    op10_lm_scoring,
    op11_minhash_dedup,
    op12_source_divergence,
    op13_importance_resampling,
)


def registry() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def statements() -> dict[str, str]:
    return {
        "op2_quality_rules": quality.policy_sql(),
        "op12_source_divergence": divergence.audit_sql(),
        "op13_importance_resampling": resampling.resample_sql(),
    }
