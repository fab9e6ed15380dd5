import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendlake.operators import substring, windows
from trendlake.operators.keywords import keyword_means
from trendlake.operators.search import search_by_keywords
from trendlake.operators.trends import match_words


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    words = ["ab", "abc", "b c", "été", "日本語", "a.b", "\U0001f600x", "zz"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12))), float(i)) for i in range(80)]
    rows += [(100, None, 1.0), (101, "", 1.0), (102, "x\nyz", 2.0)] + [(103, "same text abc", 3.0)] * 40
    return spark.createDataFrame(rows, "id int, body string, compound_score double").repartition(3)


TERMS = ["a", "b c", "abc", "bc b", "été", "本", "日本語", "\nyz", "\U0001f600", "x", "zz zz", "absent", "same text", "", None, "c", ".b", "A"]


def brute(rows, terms):
    return sorted((r.id, t) for r in rows for t in terms if t and r.body is not None and t in r.body)


@pytest.mark.parametrize("few", [64, 0])
def test_pairs_equal_brute_force_by_either_way(spark, texts, few):
    terms = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TERMS)], "rank int, term string, _x string")
    got = substring.with_terms(texts, "body", terms, few)
    assert got.columns == ["id", "body", "compound_score", "rank", "term", "_x"]
    rows = got.collect()
    assert sorted((r.id, r.term) for r in rows) == brute(texts.collect(), TERMS)
    assert all(TERMS[r.rank] == r.term for r in rows)


def test_a_listed_term_counts_as_often_as_it_is_listed(spark, texts):
    terms = spark.createDataFrame([("abc",), ("abc",)], "term string")
    one = len(brute(texts.collect(), ["abc"]))
    assert [substring.with_terms(texts, "body", terms, few).count() for few in (64, 1)] == [2 * one, 2 * one]


def test_long_list_collects_nothing_and_few_terms_shuffle_nothing(spark, texts):
    terms = spark.range(1_000).selectExpr("cast(id AS string) AS term")
    plan = substring.with_terms(texts, "body", terms)._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "collect_set" not in plan and "Join" in plan
    short = substring.with_terms(texts, "body", terms.limit(5))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in short and "hashpartitioning" not in short and "SinglePartition" not in short


def test_callers_agree_on_long_and_short_lists(spark, texts, monkeypatch):
    terms = spark.createDataFrame([(3, "ab"), (1, "zz"), (2, "absent")], "rank int, term string")
    short = sorted(map(tuple, keyword_means(texts, "body", terms).collect()))
    assert [r.matches for r in match_words(texts, ["body"], terms, 0).orderBy("id").collect()] == [r.matches for r in match_words(texts, ["body"], terms).orderBy("id").collect()]
    monkeypatch.setattr(substring.with_terms, "__defaults__", (0,))
    assert sorted(map(tuple, keyword_means(texts, "body", terms).collect())) == short
    assert match_words(texts, ["body"], terms).count() == texts.count()


def test_no_terms_and_no_texts(spark, texts):
    none = spark.createDataFrame([], "term string")
    assert substring.with_terms(texts, "body", none).count() == 0
    assert substring.with_terms(texts, "body", none, -1).count() == 0
    assert substring.with_terms(texts.limit(0), "body", spark.createDataFrame([("a",)], "term string"), 0).count() == 0


def counted(hits):
    return hits.groupBy("term").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def test_per_term_equals_brute_force_by_either_way(spark, texts):
    terms = spark.createDataFrame([(t,) for t in [*TERMS, "a", "abc"]], "term string")
    pairs = brute(texts.collect(), TERMS)
    wanted = {t: (sum(1 for _, x in pairs if x == t), sum(i for i, x in pairs if x == t)) for t in {t for _, t in pairs}}
    for few in (64, 0):
        got = substring.per_term(texts.select("id", "body"), "body", terms, counted, few).collect()
        assert len(got) == len(wanted) and {r.term: (r.n, r.ids) for r in got} == wanted


def test_long_terms_and_places_across_chunks(spark, monkeypatch):
    rng = random.Random(3)
    bodies = ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    terms = sorted({b[i : i + n] for b in bodies for n in (1, 2, 3, 4, 5, 8, 9, 17, 40, 250) for i in (0, 7, 33) if len(b) >= i + n} | {"absent" * 9})
    monkeypatch.setattr(windows, "CHUNK", 64)
    listed = pa.array(terms)
    kinds = windows.kinds_of(dict(Counter(len(t.encode()) for t in terms)))
    held = windows.Listed(kinds)
    for kind, bit in zip(*windows.bits_of(listed, kinds), strict=True):
        held.maps[kind][bit >> 3] |= 1 << (bit & 7)
    offsets, strings = held.find(pa.array(bodies))
    found = [s.decode("utf-8", "replace") for s in strings.to_pylist()]
    for body, a, b in zip(bodies, offsets[:-1], offsets[1:], strict=True):
        own = found[a:b]
        assert len(own) == len(set(own)) and set(terms) & set(own) == {t for t in terms if t in body}
        assert len(own) <= 1.2 * len(set(terms) & set(own)) + 3


def test_a_long_list_of_numbers_gives_few_candidates_and_moves_no_text(spark):
    terms = spark.range(100_000, 400_000).selectExpr("cast(id AS string) AS term")
    docs = spark.range(200).selectExpr("id", "concat_ws(' x', transform(sequence(0, 20), i -> lpad(hash(id, i) % 1000, 3, '0'))) AS body")
    pairs = substring.occurrences(docs, "body", terms, ["id"]).count()
    assert pairs <= 200  # by a gram of three digits each text had thousands
    plan = substring.per_term(docs, "body", terms, counted)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("HashAggregate")
    assert not [line for line in plan.splitlines() if "Exchange" in line and "body" in line]


def test_search_over_a_long_list_equals_one_over_short_lists(spark):
    recipes = spark.range(500).selectExpr("id", "concat('dish ', id % 90, ' of ', id % 7) AS title", "cast(hash(id) % 9 AS double) AS score")
    words = [str(i) for i in range(90)] + ["dish", "OF", "sh 1", "absent", ""]
    longer = search_by_keywords(spark.createDataFrame([(w,) for w in words], "term string"), recipes, ["title"], 4, "score").collect()
    short = [
        row for i in range(0, len(words), 40)
        for row in search_by_keywords(spark.createDataFrame([(w,) for w in words[i : i + 40]], "term string"), recipes, ["title"], 4, "score").collect()
    ]
    assert sorted(longer) == sorted(short) and len(longer) > 300
