"""Corpus vocabulary: TF-IDF ranking, topic filter, frequencies, bigrams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.constants import COSINE_THRESHOLD, MAX_FEATURES, MIN_TOPIC_KEYWORDS
from trendlake.functions.text import bigrams_of, tokens_of, word_tokens
from trendlake.functions.values import half_up, sentiment_label
from trendlake.functions.vectors import cosine
from trendlake.operators.longform import long_rows, story_row
from trendlake.operators.substring import few_rows, per_term

DOCUMENT_MARK = ""
PART_WORDS, PART_SHARE = 4 << 20, 1 << 18
CANDIDATES = 1_000
SCORES_SCHEMA = "term string, total bigint, score double"


def join_texts(df: DataFrame, columns: Sequence[str], name: str = "text") -> DataFrame:
    """Several text columns as one, null as empty; blank documents are dropped."""
    joined = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    return df.withColumn(name, joined).filter(F.trim(name) != "")


def corpus_words(df: DataFrame, text: str) -> DataFrame:
    """``words`` of every non-blank document."""
    return df.filter(F.trim(text) != "").select(word_tokens(F.col(text)).alias("words"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, total, documents) of each batch of ``words``, and a row of the empty term that counts its documents."""
    for batch in batches:
        lists = pc.fill_null(batch.column("words"), [])
        coded = lists.flatten().dictionary_encode()
        terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        owners = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        once = pd.unique(owners * max(len(terms), 1) + codes) % max(len(terms), 1)
        columns = [
            pa.concat_arrays([terms, pa.array([DOCUMENT_MARK], pa.string())]),
            *(pa.array(np.append(np.bincount(x, minlength=len(terms)), len(lists))) for x in (codes, once)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["term", "total", "documents"])


def vocabulary(words: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms with their ``total`` and ``documents``; equal totals in term order.

    The first row has the empty term and counts all documents. Both numbers are counted in
    each batch first, so one grouping of few rows adds them up.
    """
    counted = words.mapInArrow(_counted, "term string, total long, documents long").groupBy("term").agg(
        F.sum("total").alias("total"), F.sum("documents").alias("documents")
    )
    return counted.orderBy(F.col("term") != DOCUMENT_MARK, F.desc("total"), "term").limit(max_features + 1)


def tfidf_scores(df: DataFrame, text: str, max_features: int = MAX_FEATURES) -> DataFrame:
    """Mean TF-IDF per term over the non-blank documents: ``term``, ``total``, ``score``.

    The ``max_features`` most frequent terms are kept before weighting, weights are
    count x (ln((1 + N) / (1 + df)) + 1) and each document has length one. Only that
    bounded vocabulary and its scores reach the driver, so later steps do not read the
    corpus again; document vectors are never shuffled.
    """
    spark = df.sparkSession
    words = corpus_words(df, text)
    mark, *listed = vocabulary(words, max_features).collect() or [None]
    if not listed:
        return spark.createDataFrame([], SCORES_SCHEMA)
    documents = mark["documents"]
    names = [t["term"] for t in listed]
    weights = Vectors.dense([math.log((1 + documents) / (1 + t["documents"])) + 1 for t in listed])
    counted = CountVectorizerModel.from_vocabulary(names, inputCol="words", outputCol="tf")
    weighted = ElementwiseProduct(scalingVec=weights, inputCol="tf", outputCol="weighted")
    unit = Normalizer(p=2.0, inputCol="weighted", outputCol="unit")
    sums = unit.transform(weighted.transform(counted.transform(words))).agg(Summarizer.sum(F.col("unit")).alias("sums"))
    means = sums.select(vector_to_array("sums").alias("sums")).first()["sums"]
    rows = [(t["term"], t["total"], total / documents) for t, total in zip(listed, means)]
    return spark.createDataFrame(rows, SCORES_SCHEMA)


def anchor_vector(vectors: DataFrame, seeds: Column, vector: str = "vec") -> DataFrame:
    """One row: mean of the vectors where ``seeds`` holds, scaled to length one."""
    means = vectors.filter(seeds).select(F.posexplode(vector)).groupBy("pos").agg(F.avg("col").alias("x"))
    packed = means.agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("parts"))
    mean = packed.select(F.transform("parts", lambda p: p["x"]).alias("mean"))
    length = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda acc, x: acc + x * x))
    return mean.withColumn("length", length).select(
        F.transform("mean", lambda x: x / (F.col("length") + 1e-8)).alias("anchor")
    )


def vector_similarity(vectors: DataFrame, seeds: Column, vector: str = "vec") -> DataFrame:
    """``vectors`` plus ``similarity`` to the seeds' anchor."""
    anchor = anchor_vector(vectors, seeds, vector)
    return (
        vectors.withColumn("_anchor", anchor.scalar())
        .withColumn("similarity", cosine(F.col(vector), F.col("_anchor")))
        .drop("_anchor")
    )


def topic_terms(
    candidates: DataFrame,
    vocabulary: Sequence[str],
    vectors: DataFrame | None = None,
    seeds: Sequence[str] = (),
    threshold: float = COSINE_THRESHOLD,
) -> DataFrame:
    """Candidate ``term``s in the vocabulary, or whose vector lies close to the seeds' anchor."""
    listed = candidates.filter(F.lower("term").isin(list(vocabulary))).select("term")
    if vectors is None:
        return listed
    anchor = anchor_vector(vectors, F.col("term").isin(list(seeds)))
    near = (
        vectors.join(candidates.select("term"), "term", "left_semi")
        .withColumn("_anchor", anchor.scalar())
        .filter(cosine(F.col("vec"), F.col("_anchor")) > threshold)
        .select("term")
    )
    return listed.union(near).distinct()


def ranked(terms: DataFrame, top_n: int, score: str) -> DataFrame:
    """The ``top_n`` best rows with their ``rank``; only those reach the ordering window."""
    best = terms.orderBy(F.desc(score), "term").limit(top_n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), "term")))


def top_terms(
    df: DataFrame,
    text: str,
    top_n: int,
    vocabulary: Sequence[str] | None = None,
    vectors: DataFrame | None = None,
    seeds: Sequence[str] = (),
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """``rank``, ``term``, ``score`` of the best TF-IDF terms, topic-filtered when a vocabulary is given."""
    scores = tfidf_scores(df, text, max_features)
    if vocabulary is not None:
        scores = scores.join(topic_terms(scores, vocabulary, vectors, seeds), "term", "left_semi")
    return ranked(scores, top_n, "score").select("rank", "term", "score")


def term_frequencies(df: DataFrame, text: str) -> DataFrame:
    words = df.select(tokens_of(F.col(text)).alias("words"))
    return words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def trending_keywords(
    df: DataFrame,
    columns: Sequence[str],
    top_n: int = 10,
    vocabulary: Sequence[str] | None = None,
    vectors: DataFrame | None = None,
    seeds: Sequence[str] = (),
    min_results: int = MIN_TOPIC_KEYWORDS,
) -> DataFrame:
    """``rank``, ``term``, ``score`` of the topic's keywords over the joined text columns.

    With fewer than ``min_results`` TF-IDF keywords the plain frequency ranking of
    all topic words is used, and the score is the frequency.
    """
    documents = join_texts(df, columns, "_text")
    best = top_terms(documents, "_text", top_n, vocabulary, vectors, seeds).collect()
    if len(best) >= min_results:
        return df.sparkSession.createDataFrame(best, "rank int, term string, score double")
    counts = term_frequencies(documents, "_text")
    if vocabulary is not None:
        counts = counts.join(topic_terms(counts, vocabulary, vectors, seeds), "term", "left_semi")
    return ranked(counts, top_n, "n").select("rank", "term", F.col("n").cast("double").alias("score"))


def top_keywords(terms: DataFrame, run_ts: datetime) -> DataFrame:
    """Long rows of ranked terms, scored relative to the best one (100)."""
    best = F.max("score").over(Window.partitionBy())
    relative = half_up(F.coalesce(F.try_divide(F.col("score"), best) * 100, F.lit(0.0)), 1)
    row = story_row("top_keywords", "content", "rank", F.col("rank"), "tfidf_score", F.col("relative"), F.col("term"))
    return long_rows(terms.withColumn("relative", relative), [row], run_ts)


def bigram_counts(df: DataFrame, text: str, min_length: int = 6) -> DataFrame:
    """``term`` (two neighbouring words) and ``n``; pairs shorter than ``min_length`` are left out."""
    words = df.select(tokens_of(F.col(text)).alias("words"))
    pairs = words.select(F.inline(bigrams_of(F.col("words"))))
    joined = pairs.select(F.concat_ws(" ", "left", "right").alias("term")).filter(F.length("term") >= min_length)
    return joined.groupBy("term").agg(F.count("*").alias("n"))


def _parts(batches: Iterator[pa.RecordBatch], part_words: int) -> Iterator[pa.Array]:
    """The lists of ``words`` of all batches, about ``part_words`` words at a time (one list at least)."""
    held, size = [], 0
    for batch in batches:
        lists, start = batch.column("words"), 0
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < len(lists):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + part_words - size, side="right")))
            held.append(lists.slice(start, stop - start))
            size += ends[stop - 1] - base
            if stop < len(lists) or size >= part_words:
                yield pa.concat_arrays(held)
                held, size = [], 0
            start = stop
    if held:
        yield pa.concat_arrays(held)


def _neighbours(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some lists, and the codes of the left and the right word of each pair."""
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    followed = np.ones(len(codes), bool)
    followed[np.cumsum(sizes)[sizes > 0] - 1] = False
    left = np.flatnonzero(followed)
    return coded.dictionary, codes[left], codes[left + 1]


def _common_pairs(words: DataFrame, min_length: int, part_words: int, part_share: int) -> DataFrame:
    """``term``, ``n`` and ``rest`` of the pairs that are common in some part of the texts.

    A part gives the pairs that make up more than one in ``part_share`` of its own, so it gives a
    bounded number of rows. ``n`` counts a pair in those parts; ``rest`` is how often the parts
    that give it could have left out another one. The row without a term has the ``rest`` of all parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in _parts(batches, part_words):
            terms, left, right = _neighbours(lists)
            lengths, size = pc.utf8_length(terms).to_numpy(zero_copy_only=False), max(len(terms), 1)
            pairs = (left * size + right)[lengths[left] + lengths[right] + 1 >= min_length]
            found, n = np.unique(pairs, return_counts=True)
            rest = len(pairs) // part_share
            first, second = np.divmod(found[n > rest], size)
            joined = pc.binary_join_element_wise(terms.take(pa.array(first)), terms.take(pa.array(second)), " ")
            columns = [
                pa.concat_arrays([joined, pa.nulls(1, pa.string())]),
                pa.array(np.append(n[n > rest], 0)), pa.array(np.full(len(first) + 1, rest)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n", "rest"])

    counted = words.mapInArrow(run, "term string, n long, rest long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))


def _listed_pairs(words: DataFrame, listed: Sequence[str], part_words: int) -> DataFrame:
    """``term`` and ``n`` of a bounded list of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = [term.split(" ", 1) for term in listed]
        own = pa.array(sorted({word for pair in halves for word in pair}), pa.string())
        wanted = pc.index_in(pa.array([a for a, _ in halves], pa.string()), value_set=own).to_numpy().astype(np.int64) * len(own)
        wanted += pc.index_in(pa.array([b for _, b in halves], pa.string()), value_set=own).to_numpy()
        order = np.argsort(wanted)
        for lists in _parts(batches, part_words):
            terms, left, right = _neighbours(lists)
            place = pc.fill_null(pc.index_in(terms, value_set=own), -1).to_numpy().astype(np.int64)
            both = np.flatnonzero(place[left] >= 0)
            both = both[place[right[both]] >= 0]
            found, n = np.unique(place[left[both]] * len(own) + place[right[both]], return_counts=True)
            kept = np.isin(found, wanted)
            at = order[np.searchsorted(wanted, found[kept], sorter=order)]
            yield pa.RecordBatch.from_arrays([pa.array([listed[i] for i in at], pa.string()), pa.array(n[kept])], ["term", "n"])

    return words.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def frequent_bigrams(
    df: DataFrame, text: str, top_n: int, min_length: int = 6, part_words: int = PART_WORDS, part_share: int = PART_SHARE
) -> DataFrame:
    """The ``top_n`` most frequent pairs of neighbouring words, with ``n`` and ``rank``; exact, equal counts in term order.

    A pair that a part of the texts leaves out is there at most ``rest`` times, so what a pair can have in
    all is known. Only pairs that can reach the last place are counted again, unless no part
    left one of them out. Where that bound does not tell, as when no pair is much more frequent
    than others, all pairs are counted. Reads ``df`` up to twice.
    """
    words = df.select(tokens_of(F.col(text)).alias("words"))
    common = _common_pairs(words, min_length, part_words, part_share)
    order = [F.col("term").isNotNull(), F.desc(F.col("n") - F.col("rest")), "term"]
    most = max(CANDIDATES, top_n)
    mark, *found = common.orderBy(*order).limit(most + 1).collect() or [None]
    rest = mark["rest"] if mark else 0
    if rest:
        last = sorted((r["n"] for r in found), reverse=True)[top_n - 1 : top_n]
        outside = rest + max(0, found[-1]["n"] - found[-1]["rest"]) if len(found) == most else rest
        if not last or outside >= last[0]:
            return ranked(bigram_counts(df, text, min_length), top_n, "n")
        found = [r for r in found if r["n"] - r["rest"] + rest >= last[0]]
        if any(r["rest"] < rest for r in found):
            found = _listed_pairs(words, [r["term"] for r in found], part_words).collect()
    counts = df.sparkSession.createDataFrame([(r["term"], r["n"]) for r in found], "term string, n long")
    return ranked(counts, top_n, "n")


def top_bigrams(df: DataFrame, text: str, run_ts: datetime, top_n: int = 15) -> DataFrame:
    best = frequent_bigrams(df, text, top_n)
    row = story_row("top_bigrams", "content", "rank", F.col("rank"), "frequency", F.col("n"), F.col("term"))
    return long_rows(best, [row], run_ts)


def keyword_means(scored: DataFrame, text: str, terms: DataFrame, whole_words: bool = False) -> DataFrame:
    """``term`` and mean score of the documents containing it, for a list of any length."""

    def means(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("term").agg(F.avg("compound_score").alias("mean"), F.count("*").alias("documents"))

    if whole_words:
        listed, own = terms.select("term").distinct(), tokens_of(F.col(text))
        rows = few_rows(listed)
        if rows is not None:  # only words that are listed become rows
            wanted = F.array(*(F.lit(r["term"]) for r in rows if r["term"])).cast("array<string>")
            return means(scored.select(F.explode(F.array_intersect(own, wanted)).alias("term"), "compound_score"))
        return means(scored.select(F.explode(F.array_distinct(own)).alias("term"), "compound_score").join(listed, "term"))
    return per_term(scored.select(text, "compound_score"), text, terms, means)


def keyword_sentiment(
    scored: DataFrame, text: str, terms: DataFrame, run_ts: datetime, whole_words: bool = False
) -> DataFrame:
    means = keyword_means(scored, text, terms, whole_words).filter(F.col("mean").isNotNull())
    row = story_row(
        "keyword_sentiment", "sentiment", "keyword", F.col("term"), "avg_sentiment",
        half_up(F.col("mean"), 4), sentiment_label(F.col("mean")),
    )
    return long_rows(means, [row], run_ts)
