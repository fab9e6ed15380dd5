"""A corpus from raw documents to token ids: quality rules, exact and near deduplication, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import bpe, exact, jaccard, mixing, quality
from trendlake.llm.tables import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 6 << 20  # what the operators work on at once; rows are never cut, so a longer text is a batch of its own


def small_batches(stage: Stage) -> Stage:
    """``stage`` with Arrow batches of about ``BATCH_BYTES``, unless the session sets a limit itself.

    By default a batch has up to 10,000 rows, often a whole partition of texts, which an
    executor holds outside its heap and again in each Python worker. The session keeps
    the value, as a lazy result is computed later.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and come from no rejected source."""
    return quality.judge(docs).filter("kept").select("row.*")


@small_batches
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the greatest id."""
    return exact.mark(docs).filter("kept").select("row.*")


@small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (shingles of five words, 80 %) the one with the least id."""
    return jaccard.without_similar(docs)


@small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document of the mix."""
    return bpe.encode(docs, bpe.build_lexicon(docs)).withColumn("n_tokens", F.size("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

# Subset sums and merges are beyond SQL; tests/llm compares the stages with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
