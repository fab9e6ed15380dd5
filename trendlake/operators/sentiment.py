"""Lexicon sentiment (rule-based, Hutto & Gilbert 2014) inside each row.

A document's lexicon words are found in its array of words and scored with the
three words before them, so scoring needs no explode, no window and no shuffle.
The lexicon is a constant lookup. A lexicon of more than ``LEXICON_LIMIT`` tokens stays a
table: texts are dealt into groups of about ``GROUP_LETTERS``, each different word of a group
is joined to the lexicon once, as Spark chooses, and the group's texts are scored with what
was found, each text's values added up in the order of their places. So a word moves once a
group, not once for every place. Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.constants import (
    BOOSTER_STEP, DAMPENERS, DISTANCE_DAMPING, INTENSIFIERS, NEGATION_FACTOR, NEGATIONS, NORMALISATION_ALPHA,
)
from trendlake.functions.lookup import bucket_table, constant_lookup, let, look_up
from trendlake.functions.text import tokens_of
from trendlake.functions.values import half_up, sentiment_label


LEXICON_LIMIT = 20_000
GROUP_LETTERS = 8 << 20
KEYS = ["_h1", "_h2", "_h3"]


def default_boosters() -> dict[str, float]:
    return {**dict.fromkeys(INTENSIFIERS, BOOSTER_STEP), **dict.fromkeys(DAMPENERS, -BOOSTER_STEP)}


def _adjusted(valence: Column, before: Column, known: Callable, booster: Callable, negated: Callable) -> Column:
    """Valence after the intensifiers and negations among the preceding words, nearest first."""

    def apply(value: Column, word: Column) -> Column:
        sign = F.when(value < 0, -1.0).otherwise(1.0)
        step = F.coalesce(booster(word["w"]), F.lit(0.0)) * sign * word["damping"]
        flip = F.when(negated(word["w"]), F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
        return F.when((word["w"] == "") | known(word["w"]).isNotNull(), value).otherwise((value + step) * flip)

    return F.aggregate(before, valence, apply)


def _contribution(valence: Column, before: Callable[[int], Column], known: Callable, booster: Callable, negations: Sequence[str]) -> Column:
    """What a lexicon word adds, given the words ``before`` it by distance."""
    nearby = F.array(*[F.struct(before(i).alias("w"), F.lit(d).alias("damping")) for i, d in enumerate(DISTANCE_DAMPING, 1)])
    value = _adjusted(valence, nearby, known, booster, lambda word: word.isin(list(negations)))
    least = (before(1) == "least") & known(F.lit("least")).isNull() & ~before(2).isin("at", "very")
    return value * F.when(least, NEGATION_FACTOR).otherwise(1.0)


def _compound(total: Column) -> Column:
    return let(total, lambda t: half_up(t / F.sqrt(t * t + NORMALISATION_ALPHA), 4))


def token_sentiment(
    tokens: Column,
    lexicon: Callable[[Column], Column],
    listed: Callable[[Column], Column],
    boosters: Mapping[str, float],
    negations: Sequence[str],
) -> Column:
    """Compound score in [-1, 1] of an array of words; no words score 0.

    ``listed`` tests for the lexicon and runs on every word; valences and the words
    before are looked at only where it holds.
    """
    booster = constant_lookup(boosters, "double")

    def total(words: Column) -> Column:
        def add(sum_: Column, place: Column) -> Column:
            def before(distance: int) -> Column:
                return F.coalesce(F.get(words, place - distance), F.lit(""))

            return sum_ + _contribution(lexicon(F.get(words, place)), before, lexicon, booster, negations)

        scored = F.array_compact(
            F.transform(words, lambda word, i: F.when(listed(word) & ~word.isin(list(boosters)), i))
        )
        return F.aggregate(scored, F.lit(0.0), add)

    return _compound(let(tokens, total))


def _valences(lexicon: DataFrame) -> DataFrame:
    """Valence of each token; of a repeated token the greatest counts, null tokens and valences do not."""
    known = lexicon.select("token", F.col("valence").cast("double").alias("valence")).dropna()
    return known.groupBy("token").agg(F.max("valence").alias("valence"))


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a batch once."""
    for batch in batches:
        seen = batch.select(KEYS).to_pandas().duplicated().to_numpy()
        yield batch.filter(pa.array(~seen))


def _words_of(bodies: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All different words, the code of the word at each place, and the text that each place belongs to.

    The words of a text are joined by one space.
    """
    lists = pa.concat_arrays(pc.split_pattern(bodies, " ").cast(pa.large_list(pa.large_string())).chunks)
    coded = lists.flatten().dictionary_encode()
    owners = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), owners


def _group_words(texts: pa.Table) -> pa.Table:
    """The different words of a group of texts."""
    words = _words_of(texts["_body"])[0] if len(texts) else pa.array([], pa.large_string())
    group = texts["_g"][0].as_py() if len(texts) else 0
    return pa.table({"_g": pa.array([group] * len(words), pa.int64()), "token": words.cast(pa.string())})


def _group_totals(
    texts: pa.Table, found: pa.Table, known: Mapping[str, float], boosters: Mapping[str, float], negations: Sequence[str]
) -> pa.Table:
    """Sum of the values of each text of a group; ``found`` has the valences of its words.

    The same rules, in the same order, as ``_contribution``.
    """
    totals = np.zeros(len(texts))
    if len(texts) and len(found):
        words, codes, owners = _words_of(texts["_body"])
        at = pc.index_in(words, value_set=found["token"].combine_chunks().cast(pa.large_string()))
        valence = found["valence"].combine_chunks().take(at).to_numpy(zero_copy_only=False)

        def per_word(values: Mapping[str, float], otherwise: float) -> np.ndarray:
            """Number of each different word, and last the one of no word at all."""
            numbers, listed = np.full(len(words) + 1, otherwise), pa.array(list(values), pa.large_string())
            place = pc.fill_null(pc.index_in(words, value_set=listed), -1).to_numpy()
            numbers[:-1][place >= 0] = np.array(list(values.values()), float)[place[place >= 0]]
            return numbers

        changing = {w: x for w, x in boosters.items() if w and w not in known}
        flipping = {w: NEGATION_FACTOR for w in negations if w and w not in known}
        step, flip = per_word(changing, 0.0), per_word(flipping, 1.0)
        scoring = ~np.isnan(valence) & (per_word(dict.fromkeys(boosters, 1.0), 0.0)[:-1] == 0)
        places = np.flatnonzero(scoring[codes])
        first = np.searchsorted(owners, owners[places])

        def before(distance: int) -> np.ndarray:
            near = places - distance
            return np.where(near >= first, codes[np.maximum(near, 0)], len(words))

        value = valence[codes[places]]
        for distance, damping in enumerate(DISTANCE_DAMPING, 1):
            sign = np.where(value < 0, -1.0, 1.0)
            value = (value + step[before(distance)] * sign * damping) * flip[before(distance)]
        if "least" not in known:
            least = per_word({"least": 1.0}, 0.0)[before(1)] * (1.0 - per_word({"at": 1.0, "very": 1.0}, 0.0)[before(2)])
            value = value * np.where(least > 0, NEGATION_FACTOR, 1.0)
        totals = np.bincount(owners[places], weights=value, minlength=len(texts)).astype(float)
    return texts.select(KEYS).append_column("_total", pa.array(totals))


def _joined_scores(
    df: DataFrame, text: str, valences: DataFrame, boosters: Mapping[str, float], negations: Sequence[str]
) -> DataFrame:
    """``df`` plus ``compound_score`` by a join of the words of groups of texts to the lexicon.

    Texts are known by 96 bits of hashes and their length; copies are merged in each batch, and the
    totals of equal texts are one set. The number of groups grows with the letters of the table, so
    a group's size is bounded. Only words that boost or negate need to be known before others,
    and those are a bounded part of the lexicon.
    """
    keys = {"_h1": F.xxhash64(text), "_h2": F.hash(text), "_h3": F.length(text)}
    special = sorted({*boosters, *negations, "least"})
    known = {r["token"]: r["valence"] for r in valences.filter(F.col("token").isin(special)).collect()}
    filled = df.filter(F.trim(text) != "")
    groups = (filled.agg(F.sum(F.length(text).cast("long")).alias("n")).first()["n"] or 0) // GROUP_LETTERS + 1
    columns = "_g long, _h1 long, _h2 int, _h3 int, _body string"
    bodies = filled.withColumns(keys).select(
        F.pmod("_h1", F.lit(groups)).cast("long").alias("_g"), *KEYS, F.array_join(tokens_of(F.col(text)), " ").alias("_body")
    )
    texts = bodies.mapInArrow(_different, columns)
    words = texts.groupBy("_g").applyInArrow(_group_words, "_g long, token string")
    found = words.join(valences, "token").select("_g", "token", "valence")

    def totals(left: pa.Table, right: pa.Table) -> pa.Table:
        return _group_totals(left, right, known, boosters, negations)

    grouped = texts.groupBy("_g").cogroup(found.groupBy("_g")).applyInArrow(totals, "_h1 long, _h2 int, _h3 int, _total double")
    sums = grouped.groupBy(*KEYS).agg(F.get(F.collect_set("_total"), 0).alias("_total"))
    scores = sums.select(*KEYS, _compound(F.col("_total")).alias("_score"))
    joined = df.withColumns(keys).join(scores, KEYS, "left")
    return joined.select(*df.columns, F.coalesce("_score", F.lit(0.0)).alias("compound_score"))


def add_sentiment(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    boosters: Mapping[str, float] | None = None,
    negations: Sequence[str] = tuple(NEGATIONS),
    limit: int = LEXICON_LIMIT,
) -> DataFrame:
    """``df`` plus ``compound_score`` and ``sentiment_label`` of a cleaned text column.

    ``lexicon`` has ``token`` and ``valence`` and may have any size; up to ``limit`` tokens
    it becomes a constant, a larger one is joined.
    """
    boosters = default_boosters() if boosters is None else boosters
    known = _valences(lexicon)
    rows = known.limit(limit + 1).collect()
    if len(rows) > limit:
        with_score = _joined_scores(df, text, known, boosters, negations)
    else:
        def scored(table: Column) -> Column:
            lookup = partial(look_up, table)
            return token_sentiment(tokens_of(F.col(text)), lookup, lambda w: lookup(w).isNotNull(), boosters, negations)

        valences = {r["token"]: r["valence"] for r in rows}
        with_score = df.withColumn("compound_score", let(bucket_table(valences, "double"), scored))
    return with_score.withColumn("sentiment_label", sentiment_label(F.col("compound_score")))
