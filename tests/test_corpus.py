import math
import re
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.functions import text
from trendlake.operators import entities, keywords, sentiment

TS = datetime(2026, 5, 27, 12)
STOP = ["the", "of", "and"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select("doc_id", "source", text.clean_text(F.col("text"), STOP).alias("clean")).persist()


def python_score(words, lexicon, boosters, negations):
    """The published rules, word by word."""
    total = 0.0
    for i, word in enumerate(words):
        if word not in lexicon or word in boosters:
            continue
        value = lexicon[word]
        for distance, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < distance or words[i - distance] in lexicon:
                continue
            before = words[i - distance]
            value += boosters.get(before, 0.0) * damping * (-1 if value < 0 else 1)
            if before in negations:
                value *= -0.74
        if i > 0 and words[i - 1] == "least" and "least" not in lexicon and (i < 2 or words[i - 2] not in ("at", "very")):
            value *= -0.74
        total += value
    return math.floor(total / math.sqrt(total * total + 15) * 1e4 + 0.5) / 1e4


LEXICON = {"that": 1.9, "with": 2.3, "was": -1.8, "for": 0.9, "on": -0.7, "les": -1.3, "mit": -2.2, "great": 3.1, "bad": -2.5}
BOOSTERS = {"to": 0.293, "in": -0.293, "very": 0.293}
NEGATIONS = ["it", "not", "never"]


def test_sentiment_on_documents_agrees_with_brute_force(spark, docs):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    scored = sentiment.add_sentiment(docs, "clean", lexicon, boosters=BOOSTERS, negations=NEGATIONS)
    rows = scored.select("clean", "compound_score").collect()
    assert all(abs(r.compound_score) < 1 for r in rows)
    for r in rows:
        assert r.compound_score == pytest.approx(python_score(r.clean.split(), LEXICON, BOOSTERS, NEGATIONS), abs=1.1e-4)
    # Beyond the limit the lexicon is joined, with copies and blank texts as well.
    more = docs.select("clean").union(docs.select("clean")).union(docs.sparkSession.createDataFrame([(None,), ("",), ("least great not to bad",)], "clean string"))
    either = [sentiment.add_sentiment(more, "clean", lexicon, boosters=BOOSTERS, negations=NEGATIONS, limit=n) for n in (2, 100)]
    counted = [sorted(Counter(map(tuple, df.collect())).items(), key=repr) for df in either]
    assert counted[0] == counted[1]
    assert "collect_set" in either[0]._jdf.queryExecution().toString()


def test_sentiment_is_the_same_at_any_lexicon_size(spark):
    small = spark.createDataFrame([("great", 3.1), ("bad", -2.5), ("great", 1.0), (None, 4.0), ("good", None)], "token string, valence double")
    filler = spark.range(100_000).select(F.concat(F.lit("zz"), F.col("id").cast("string")).alias("token"), F.lit(1.0).alias("valence"))
    df = spark.createDataFrame([(None, "very great"), (1, "not bad great"), (1, "good"), (2, None)], "k int, clean string")
    few, many = (sentiment.add_sentiment(df, "clean", lexicon).collect() for lexicon in (small, small.union(filler)))
    assert few == many and few[0].compound_score == pytest.approx(python_score(["very", "great"], {"great": 3.1}, sentiment.default_boosters(), []), abs=1.1e-4)
    assert few[2].compound_score == 0.0


def test_large_lexicon_moves_each_word_of_a_group_once(spark, monkeypatch):
    """Texts in several groups score as with a constant lexicon; no row is made for each place of a word."""
    monkeypatch.setattr(sentiment, "GROUP_LETTERS", 2_000)
    rng = np.random.default_rng(5)
    words = [*LEXICON, *BOOSTERS, *NEGATIONS, "least", "at", "very", "other", "Straße", "日本"]
    gaps = [" ", " ", "  ", "\t", "\n "]
    texts = ["".join(w + rng.choice(gaps) for w in rng.choice(words, rng.integers(0, 40))) for _ in range(300)]
    odd = [(t,) for t in [*texts, *texts[:50], "\t", "\tgreat", " bad ", "least great", "at least great", None, "", "great " * 900]]
    df = spark.createDataFrame(odd, "clean string")
    for listed in (LEXICON, {**LEXICON, "least": -0.3, "to": 1.3, "not": -0.6, "": 0.7}):
        lexicon = spark.createDataFrame(list(listed.items()), "token string, valence double")
        few, many = (sentiment.add_sentiment(df, "clean", lexicon, BOOSTERS, NEGATIONS, limit=n) for n in (100, 2))
        assert Counter(map(tuple, many.collect())) == Counter(map(tuple, few.collect()))
        assert "Generate" not in many._jdf.queryExecution().toString()


def test_sentiment_rules(spark):
    lexicon = spark.createDataFrame([("great", 3.1), ("bad", -2.5)], "token string, valence double")
    cases = [
        "great", "very great", "never great", "very bad", "not very great", "x x x never great", "least great",
        "at least great", "great great", "", None, "   ", "barely bad", "never bad great",
    ]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, clean string")
    scored = sentiment.add_sentiment(df, "clean", lexicon).orderBy("i").collect()
    expected = [
        python_score((c or "").split(), {"great": 3.1, "bad": -2.5}, sentiment.default_boosters(), sentiment.NEGATIONS)
        for c in cases
    ]
    assert [r.compound_score for r in scored] == pytest.approx(expected, abs=1.1e-4)
    assert scored[9].sentiment_label == "neutral" and scored[2].sentiment_label == "negative"


def python_tfidf(texts, size):
    texts = [t for t in texts if t and t.strip()]
    counts = [Counter(re.findall(r"\b\w\w+\b", t.lower())) for t in texts]
    total = Counter()
    for c in counts:
        total.update(c)
    terms = [t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]
    df = {t: sum(t in c for c in counts) for t in terms}
    weights = np.array([math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in terms])
    sums = np.zeros(len(terms))
    for c in counts:
        row = np.array([c[t] for t in terms]) * weights
        length = np.linalg.norm(row)
        sums += row / length if length else row
    return dict(zip(terms, sums / len(texts)))


@pytest.mark.parametrize("size", [20, 500])
def test_tfidf_agrees_with_brute_force(spark, docs, size):
    extra = docs.select("clean").union(spark.createDataFrame([(None,), ("",), ("  ",), ("zzqq",)], "clean string"))
    got = {r.term: r.score for r in keywords.tfidf_scores(extra, "clean", size).collect()}
    expected = python_tfidf([r.clean for r in extra.collect()], size)
    assert set(got) == set(expected)
    assert all(got[t] == pytest.approx(expected[t], rel=1e-9) for t in expected)


def test_empty_corpus_gives_no_keywords(spark):
    empty = spark.createDataFrame([("",), (None,)], "clean string")
    assert keywords.tfidf_scores(empty, "clean").count() == 0
    assert keywords.trending_keywords(empty, ["clean"], vocabulary=["a"]).count() == 0


def test_top_keywords_are_relative_to_the_best(spark, docs):
    terms = keywords.top_terms(docs, "clean", 5)
    rows = sorted(keywords.top_keywords(terms, TS).collect(), key=lambda r: int(r.dimension_value))
    assert [r.dimension_value for r in rows] == ["1", "2", "3", "4", "5"] and rows[0].value == 100.0


@pytest.fixture(scope="module")
def topic(spark):
    corpus = spark.createDataFrame([("pizza oven hot",), ("pizza sauce table",), ("ramen Chair lamp",)], "clean string")
    vectors = spark.createDataFrame(
        [("pizza", [1.0, 0.0]), ("ramen", [0.9, 0.1]), ("chair", [0.0, 1.0]), ("sauce", [0.7, 0.4])],
        "term string, vec array<float>",
    )
    return corpus, vectors


def test_topic_filter_uses_vocabulary_and_vectors(topic):
    corpus, vectors = topic
    scores = keywords.tfidf_scores(corpus, "clean")
    near = keywords.topic_terms(scores, ["oven"], vectors, ["pizza", "ramen"])
    assert {r.term for r in near.collect()} == {"oven", "pizza", "ramen", "sauce"}
    assert {r.term for r in keywords.topic_terms(scores, ["oven"]).collect()} == {"oven"}


def test_trending_keywords_fall_back_to_frequency(topic):
    corpus, vectors = topic
    ranked = keywords.trending_keywords(corpus, ["clean"], 10, ["oven"], vectors, ["pizza", "ramen"])
    assert [r.rank for r in ranked.collect()] == [1, 2, 3, 4]
    assert {r.term for r in ranked.collect()} == {"oven", "pizza", "ramen", "sauce"}
    few = keywords.trending_keywords(corpus, ["clean"], 10, ["pizza", "ramen"])
    assert [(r.rank, r.term, r.score) for r in few.collect()] == [(1, "pizza", 2.0), (2, "ramen", 1.0)]


def test_anchor_and_similarity(topic):
    _, vectors = topic
    got = {r.term: r.similarity for r in keywords.vector_similarity(vectors, F.col("term").isin("pizza", "ramen")).collect()}
    anchor = np.array([0.95, 0.05]) / np.linalg.norm([0.95, 0.05])
    assert got["chair"] == pytest.approx(anchor[1], abs=1e-6)


def test_bigrams(docs, spark):
    counts = Counter()
    for r in docs.collect():
        words = r.clean.split()
        counts.update(b for b in (f"{a} {b}" for a, b in zip(words, words[1:])) if len(b) > 5)
    got = {r.term: r.n for r in keywords.bigram_counts(docs, "clean").collect()}
    assert got == dict(counts)
    odd = spark.createDataFrame([(None,), ("",), ("single",), ("two words",)], "clean string")
    assert [tuple(r) for r in keywords.bigram_counts(odd, "clean").collect()] == [("two words", 1)]
    rows = keywords.top_bigrams(docs, "clean", TS, 3).collect()
    assert [r.dimension_value for r in rows] == ["1", "2", "3"]


def test_top_bigrams_leave_rare_pairs_where_they_are(spark, monkeypatch):
    """The best pairs come out exact without a count of all pairs, whether they lie in few texts or in many."""
    rng = np.random.default_rng(3)
    rare = [" ".join(f"w{i}" for i in rng.integers(0, 5_000, 200)) for _ in range(150)]
    often = [f"{t} common pair here common pair" if i % 2 else f"{t}  second pair " for i, t in enumerate(rare)]
    lone = " ".join(["single text"] * 130)
    df = spark.createDataFrame([(t,) for t in [*often, lone, None, "", "\todd", "a b " * 300]], "clean string").repartition(3)
    want = keywords.ranked(keywords.bigram_counts(df, "clean"), 4, "n").collect()
    assert [tuple(r) for r in want][:2] == [("common pair", 150, 1), ("single text", 130, 2)]
    flat = df.filter("clean like 'w%'").select(F.regexp_replace("clean", " (common|second) .*", "").alias("clean"))
    flat_want = keywords.ranked(keywords.bigram_counts(flat, "clean"), 4, "n").collect()
    assert keywords.frequent_bigrams(flat, "clean", 4, 6, 3_000, 100).collect() == flat_want  # no pair stands out: all are counted
    assert keywords.frequent_bigrams(df, "clean", 4).collect() == want  # small parts leave nothing out
    counted = keywords._common_pairs(df.select(text.tokens_of(F.col("clean")).alias("words")), 6, 3_000, 1_000)
    assert counted.count() < 3_000 < keywords.bigram_counts(df, "clean").count()
    monkeypatch.delattr(keywords, "bigram_counts")
    assert keywords.frequent_bigrams(df, "clean", 2, 6, 3_000, 1_000).collect() == want[:2]
    assert keywords.frequent_bigrams(df.limit(0), "clean", 2).count() == 0


def test_keyword_sentiment_substring_and_whole_word(spark):
    scored = spark.createDataFrame([("hot pizzas", 0.5), ("pizza", -0.1), ("tea", 0.0)], "clean string, compound_score double")
    terms = spark.createDataFrame([(1, "pizza", 1.0), (2, "none", 1.0)], "rank int, term string, score double")
    inside = keywords.keyword_sentiment(scored, "clean", terms, TS).collect()
    assert [(r.dimension_value, r.value, r.label) for r in inside] == [("pizza", 0.2, "positive")]
    whole = keywords.keyword_sentiment(scored, "clean", terms, TS, whole_words=True).collect()
    assert [(r.value, r.label) for r in whole] == [(-0.1, "negative")]


def test_entities(spark):
    rows = [("Le Bernardin returns to Midtown",), ("MIDTOWN east: le bernardin, Le Bernardin!",), (None,), ("Midtowner",)]
    df = spark.createDataFrame(rows, "title string")
    names = [("Le Bernardin", "restaurant"), ("Midtown", "neighborhood"), ("Midtown East", "neighborhood"),
             ("Eric Ripert", "chef"), ("x", "chef")]
    gazetteer = spark.createDataFrame(names, "name string, entity_type string")
    got = {(r.entity_type, r.name): r.mentions for r in entities.entity_counts(df, "title", gazetteer).collect()}
    assert got == {("restaurant", "Le Bernardin"): 3, ("neighborhood", "Midtown"): 2, ("neighborhood", "Midtown East"): 1}
    filler = spark.range(60_000).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("name"), F.lit("chef").alias("entity_type"))
    large = entities.entity_counts(df, "title", gazetteer.union(filler))
    assert {(r.entity_type, r.name): r.mentions for r in large.collect()} == got
    best = entities.named_entities(df, "title", gazetteer, TS, top_n=1).collect()
    assert {(r.dimension_value, r.label) for r in best} == {("restaurant", "Le Bernardin"), ("neighborhood", "Midtown")}
    assert entities.entity_counts(df, "title", gazetteer.limit(0)).count() == 0
    both = spark.createDataFrame([("T", "abcdef")], "title string, summary string")
    assert both.select(entities.entity_text("title", "summary", 3)).first()[0] == "T. abc"
