"""A training-data pipeline in stages; each stage's documents are written and read by the next one.

    documents -> language -> one of each group of near copies -> without repeated passages
              -> without benchmark items -> packed sequences
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyvault.llm import chaining, decontamination, language, ngram_join, packing
from tallyvault.llm.queries import tokenizer_path
from tallyvault.llm.shared import bound_batches, drop, keep, tables_of_a_step

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SHARE = 0.5  # of a document's letters that its language must have


def select_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents most of whose letters are in one language that the corpus' own labels teach."""
    found = language.identify(docs, F.lit(False), carry=COLUMNS)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select("extra.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similar ones connect, that of the smallest doc_id; rows without one stay.

    Of rows that repeat a doc_id, the one whose columns come first in order stays.
    """
    classes = ngram_join.similar_classes(docs)
    first = classes.where("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(COLUMNS)
    one = Window.partitionBy("doc_id").orderBy(*(F.col(c).asc_nulls_last() for c in COLUMNS[1:]))
    known = rows.join(first, "doc_id", "left_semi").withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return known.drop("_n").unionByName(rows.where("doc_id IS NULL")).select(COLUMNS)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of earlier ones; one of which nothing is left goes."""
    cut = chaining.without_passages(docs, carry=["lang", "source"])
    left = cut.where("n_removed = 0 OR n_removed < n_words")
    return left.select("doc_id", "text", "extra.lang", "extra.source", F.length("text").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(docs, benchmark, carry=COLUMNS)
    return found.where("NOT contaminated").select("extra.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences."""
    return packing.pack(docs, tokenizer_path(), with_ids=False).drop("ids")


def _bounded(stage: Stage) -> Stage:
    """The stage, in a session that sends texts to Python in small batches."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _bounded(select_language)),
    ("ngram_jaccard_join", _bounded(drop_near_copies)),
    ("substring_dedup", _bounded(cut_passages)),
    ("benchmark_decontamination", _bounded(drop_contaminated)),
    ("best_fit_packing", _bounded(pack_sequences)),
]
ORACLE_SQL = None  # a model, chains and a packing search are beyond SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way goes when its documents are written, and
    these when the next stage's are; the last stage's tables stay, as its rows are read by the caller."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with tables_of_a_step(spark) as written:
            docs = keep(stage(spark, docs, sf_dir))
            written.pop()  # the documents themselves
        if last is not None:
            drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
