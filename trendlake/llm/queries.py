"""The registered queries of this subpackage: name -> function of (session, table directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendlake.llm import bpe, classifier, exact, jaccard, mixing, neighbours, pseudonyms, quality, repair, runs, secrets, sequences, urls
from trendlake.llm.oracle import ORACLE as ORACLE


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_bpe(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return bpe.digests(docs, bpe.build_lexicon(docs))


def op2_jaccard(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, directory, "documents"), width=3, percent=90)


def op3_pseudonyms(spark: SparkSession, directory: str) -> DataFrame:
    return pseudonyms.replace_personal(table(spark, directory, "documents"), secret="a key that a job takes from its own secret store")


def op4_urls(spark: SparkSession, directory: str) -> DataFrame:
    return urls.judge_urls(table(spark, directory, "pages"))


def op5_exact(spark: SparkSession, directory: str) -> DataFrame:
    marked = exact.mark(table(spark, directory, "documents"), carry=["doc_id"])
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_quality(spark: SparkSession, directory: str) -> DataFrame:
    judged = quality.judge(table(spark, directory, "documents"), carry=["doc_id"])
    return judged.select("row.doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_mixing(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mixing.mix(table(spark, directory, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op8_secrets(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    return secrets.scan(docs, words=secrets.common_words(docs))


def op9_classifier(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    return classifier.score(docs, classifier.fit(docs, table(spark, directory, "labels")))


def op10_sequences(spark: SparkSession, directory: str) -> DataFrame:
    return sequences.round_trip(table(spark, directory, "documents"))


def op11_runs(spark: SparkSession, directory: str) -> DataFrame:
    return runs.digests(table(spark, directory, "documents"))


def op12_repair(spark: SparkSession, directory: str) -> DataFrame:
    return repair.digests(table(spark, directory, "conversations"))


def op13_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return neighbours.similar_vectors(table(spark, directory, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_urls": op4_urls,
    "op5_exact": op5_exact,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_classifier": op9_classifier,
    "op10_sequences": op10_sequences,
    "op11_runs": op11_runs,
    "op12_repair": op12_repair,
    "op13_neighbours": op13_neighbours,
}
