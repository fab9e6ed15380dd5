from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendlake.operators import search, trends

TS = datetime(2026, 5, 27, 12)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (1, "ramen noodles broth 1234", 0.6, "positive", ["Food", " News "], "Tue, 26 May 2026 10:11:12 +0000"),
        (2, "ramen again", 0.2, "positive", ["Food", ""], "2026-05-25"),
        (3, "closed doors", -0.4, "negative", [], "bad"),
        (4, None, 0.0, "neutral", None, "2026-06-01T01:00:00"),
    ]
    schema = "id int, clean string, compound_score double, sentiment_label string, categories array<string>, published_date string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def recipes(spark):
    rows = [
        (1, "Ramen bowl", "Asian, Japanese", "soup", 90.0, 10.0, 5, True, None, 30, "noodle, egg", "vegan, gluten free"),
        (2, "Plain toast", None, None, 50.0, None, None, True, False, 5, "bread", "vegetarian"),
        (3, "ramen Noodles", "Japanese", None, None, 30.0, 7, False, False, None, "noodle", None),
    ]
    schema = (
        "id int, title string, cuisines string, dishTypes string, spoonacularScore double, healthScore double, "
        "aggregateLikes int, vegan boolean, glutenFree boolean, readyInMinutes int, ingredient_names string, diets string"
    )
    return spark.createDataFrame(rows, schema)


def facts(df):
    return {(r.dimension_value, r.metric): (r.value, r.label) for r in df.collect()}


def test_distribution(scored):
    got = facts(trends.sentiment_distribution(scored, TS))
    assert got[("positive", "count")] == (2.0, "50.0% of articles")
    assert got[("negative", "percentage")] == (25.0, "1 articles")
    assert got[("all", "avg_compound_score")] == (0.1, "mean score")
    assert sum(v for (_, m), (v, _) in got.items() if m == "count") == 4
    assert trends.sentiment_distribution(scored.limit(0), TS).count() == 0


def test_weekly_and_daily(scored):
    got = facts(trends.sentiment_trend(scored, TS))
    assert got[("2026-05-25 00:00:00", "avg_sentiment")] == (0.4, "2 articles")
    assert got[("2026-06-01 00:00:00", "article_count")][0] == 1.0
    assert set(facts(trends.volume_trends(scored, TS))) == {
        ("2026-05-25", "article_count"), ("2026-05-26", "article_count"), ("2026-06-01", "article_count"),
    }


def test_categories_from_array_and_csv(scored):
    expected = {"Food": (2, 0.4, 2, 0), "News": (1, 0.6, 1, 0)}
    csv = scored.withColumn("categories", F.array_join("categories", ","))
    for df in (scored, csv):
        got = {r.cat: (r.n, pytest.approx(r["mean"]), r.positive, r.negative) for r in trends.category_counts(df).collect()}
        assert got == expected
    assert facts(trends.category_breakdown(scored, TS))[("News", "avg_sentiment")] == (0.6, "positive")
    with pytest.raises(ValueError):
        trends.category_breakdown(scored.drop("categories"), TS)


def test_flags_and_sources(scored, recipes):
    flags = facts(trends.flag_breakdown(recipes, TS))
    assert flags[("vegan", "count")] == (2.0, "Vegan: 66.67% of recipes")
    assert flags[("glutenFree", "percentage")] == (0.0, "Gluten-free")
    assert trends.flag_breakdown(recipes.limit(0), TS).count() == 0
    got = facts(trends.source_comparison(scored, recipes, TS))
    assert got[("web_articles", "avg_sentiment")] == (0.1, "4 web articles")
    assert got[("api_recipes", "avg_spoonacular_score")][0] == 70.0


def test_alignment(scored, recipes):
    words = trends.buzz_words(scored, "clean")
    assert [r.term for r in words.collect()] == ["ramen", "again", "broth", "noodles"]
    got = facts(trends.trend_alignment(recipes, words, TS))
    assert got[("3", "matched_keywords")] == (2.0, "ramen|noodles")
    assert got[("2", "trend_score")] == (0.0, "Plain toast") and ("2", "matched_keywords") not in got
    assert got[("3", "spoonacular_score")][0] == 0.0
    none_positive = scored.filter("compound_score < 0")
    assert [r.term for r in trends.buzz_words(none_positive, "clean").collect()] == ["closed", "doors"]


def test_keyword_search(spark, recipes):
    terms = spark.createDataFrame([(1, "Ramen"), (2, "bread"), (3, "nothing")], "rank int, term string")
    hits = search.search_by_keywords(terms, recipes, ["title", "ingredient_names"], number=1).collect()
    assert {(r.query, r.id) for r in hits} == {("ramen", 1), ("bread", 2)}


def test_ingredient_search(recipes):
    def ids(**options):
        found = search.search_by_ingredients(["noodle", "bread"], recipes, **options).collect()
        return {(r.query, r["rank"], r.id) for r in found}

    assert ids() == {("noodle", 1, 1), ("noodle", 2, 3), ("bread", 1, 2)}
    assert ids(diet="vegan|vegetarian") == {("noodle", 1, 1), ("bread", 1, 2)}
    assert ids(diet="vegan,gluten free") == {("noodle", 1, 1)}
    assert ids(intolerances="gluten") == {("noodle", 1, 1)}
    assert ids(number=1) == {("noodle", 1, 1), ("bread", 1, 2)}


def test_recipe_list_and_lookup(spark, recipes):
    rows = search.recipe_list(recipes, limit=1, cuisine="JAPAN").collect()
    assert [(r.id, r["rank"], r.total) for r in rows] == [(1, 1, 2)]
    assert [r.id for r in search.recipe_list(recipes, diet="vegan").collect()] == [1, 2]
    assert [r.id for r in search.recipe_list(recipes, max_minutes=5).collect()] == [2]
    assert search.recipe_list(recipes, max_minutes=0).count() == 0
    with pytest.raises(ValueError):
        search.recipe_list(recipes, limit=101)
    assert search.recipe_by_id(recipes, 3).first().cuisines == "Japanese"
    assert search.recipe_by_id(recipes, 99).count() == 0
    stored = spark.createDataFrame([(1,)], "id int")
    assert sorted(r.id for r in search.missing_keys(recipes, stored, "id").collect()) == [2, 3]
