import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendlake.plans import daily, gold, governance, serving, silver
from trendlake.sources import landed
from trendlake.streaming import articles as stream

TS = datetime(2026, 5, 27, 12)
STOP = ["the", "a", "of"]


def recipe(i, title, **more):
    return {
        "id": i, "title": title, "vegan": i % 2 == 0, "vegetarian": True, "glutenFree": None, "dairyFree": False,
        "veryHealthy": False, "healthScore": float(i), "spoonacularScore": 50.0 + i, "aggregateLikes": i,
        "readyInMinutes": 10 * i, "pricePerServing": 1.5 * i, "summary": f"<b>{title}</b> dish", "cuisines": ["Asian"],
        "dishTypes": ["soup"], "diets": ["vegan"], "preparationMinutes": "x",
        "extendedIngredients": [{"name": "oyster"}], "analyzedInstructions": [{"steps": [{"step": "Stir."}]}], **more,
    }


def article(i, summary, **more):
    return {
        "source": "feed", "article_title": f"Ramen &amp; more {i}", "article_url": f"http://x/{i}", "article_id": f"a{i}",
        "author": "Ann", "article_summary": summary, "categories": ["Food", "News"], "location_focus": "here",
        "published_date": "Tue, 26 May 2026 10:11:12 +0000", "date_extracted": "20260527_080000", **more,
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    posts = base / "bronze" / "articles" / "dt=2026-05-27"
    posts.mkdir(parents=True)
    (posts / "one.json").write_text(json.dumps([article(1, "A dish. | Jo Doe The great ramen broth"), article(2, "bad pizza")]))
    (posts / "two.json").write_text(json.dumps([article(1, "second copy"), article(3, "great ramen again", published_date="bad")]))
    dishes = base / "bronze" / "recipes" / "dt=2026-05-27"
    dishes.mkdir(parents=True)
    (dishes / "r1.json").write_text(json.dumps({"results": [recipe(1, "Ramen bowl", license=5), recipe(2, "Toast")]}))
    (dishes / "r2.json").write_text(json.dumps({"results": [recipe(1, "Ramen bowl", license="CC")]}))
    old = base / "bronze" / "articles" / "dt=2026-01-01"
    old.mkdir(parents=True)
    (old / "old.json").write_text("[]")
    catalogue = landed.read_recipes(spark, str(dishes / "r2.json")).drop("_source_file").withColumns(
        {"id": F.lit(77).cast("bigint"), "title": F.lit("Pizza pie")}
    )
    inputs = daily.Inputs(
        lexicon=spark.createDataFrame([("great", 3.1), ("bad", -2.5)], "token string, valence double"),
        stop_words=STOP, vocabulary=["ramen", "pizza", "broth"],
        gazetteer=spark.createDataFrame([("Ramen", "restaurant")], "name string, entity_type string"), catalogue=catalogue,
    )
    target = str(base / "published")
    written = daily.run_daily(spark, str(base), inputs, TS, target)
    return base, target, written


def test_daily_run_writes_every_table(lake, spark):
    base, target, written = lake
    assert written["silver_articles"] == 3 and written["gold_articles"] == 3
    assert written["silver_recipes"] == 4 and written["gold_recipes"] == 3
    assert not (base / "bronze" / "articles" / "dt=2026-01-01").exists()
    posts = {r.article_id: r for r in spark.read.parquet(f"{target}/gold_articles").collect()}
    assert posts["a1"].article_summary_clean == "great ramen broth"
    assert posts["a1"].article_title == "Ramen & more 1" and posts["a1"].article_title_clean == "ramen more"
    dishes = {r.id: r for r in spark.read.parquet(f"{target}/gold_recipes").collect()}
    assert set(dishes) == {1, 2, 77}
    assert dishes[2].dietary_tags == ["vegetarian", "vegan"] and dishes[1].summary == "Ramen bowl dish"
    assert dishes[1].ingredient_names == "oyster" and dishes[1].cuisines == "Asian"


def test_a_day_can_be_run_again_and_after_later_ones(spark, tmp_path):
    for day in (27, 28):
        posts, dishes = (tmp_path / "bronze" / t / f"dt=2026-05-{day}" for t in ("articles", "recipes"))
        posts.mkdir(parents=True)
        dishes.mkdir(parents=True)
        (posts / "one.json").write_text(json.dumps([article(day, "great ramen")]))
        (dishes / "r.json").write_text(json.dumps({"results": [recipe(day, "Ramen bowl")]}))
    catalogue = landed.read_recipes(spark, str(tmp_path / "bronze/recipes/dt=2026-05-28")).drop("_source_file")
    inputs = daily.Inputs(spark.createDataFrame([("great", 3.1)], "token string, valence double"), STOP, ["ramen"], catalogue=catalogue)
    first = daily.run_daily(spark, str(tmp_path), inputs, TS)
    assert daily.run_daily(spark, str(tmp_path), inputs, TS) == first
    stored = spark.read.parquet(f"{tmp_path}/silver/articles").select("article_id", F.col("dt").cast("string").alias("dt"))
    assert [tuple(r) for r in stored.collect()] == [("a27", "2026-05-27")]
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not [d for d in os.listdir(folder) if d.startswith("job-")]


def test_governance_serving(lake, spark):
    facts = spark.read.parquet(f"{lake[1]}/governance")
    values = {(r.kpi_name, r.source, r.field): r.value for r in facts.collect()}
    assert values[("record_count", "api", None)] == 4 and values[("duplicate_rate", "api", "id")] == 25.0
    assert values[("duplicate_rate", "webscraping", "article_id")] == 0.0
    assert values[("null_rate", "api", "preparationMinutes")] == 100.0
    assert values[("ingredient_coverage", "api", None)] == 5.26
    assert values[("schema_compliance_rate", "webscraping", None)] == 100.0
    assert values[("ingestion_distinct_dates", "webscraping", None)] == 2.0
    assert values[("ingestion_file_count", "api", None)] == 3.0
    assert ("nlp_compression_ratio", "webscraping", "article_summary_clean") in values
    summary = serving.kpi_summary(facts).first()
    assert (summary.total_records, summary.max_null_rate, summary.duplicate_rate) == (7, 100.0, 25.0)
    severities = {r.severity for r in serving.null_severity(facts).collect() if r.value > 80}
    assert severities == {"high"}
    assert serving.fact_rows(facts).first().row_count == facts.count()
    assert {r.date for r in serving.volume_by_day(facts).collect()} == {"2026-05-27"}
    assert serving.kpi_table(facts).columns == serving.KPI_TABLE_COLUMNS
    assert {r.category: r.kpi_names for r in serving.kpi_names_per_category(facts).collect()}["timeliness"] == 2
    assert "null_rate" in serving.distinct_names(facts, ["kpi_name", "category"]).first().kpi_name
    assert serving.outliers_over(facts).filter("over_threshold").count() == 0


def test_storytelling_serving(lake, spark):
    facts = spark.read.parquet(f"{lake[1]}/storytelling")
    names = {r.aggregation for r in facts.collect()}
    assert names == {
        "sentiment_distribution", "sentiment_trend", "top_keywords", "top_bigrams", "keyword_sentiment", "source_comparison",
        "volume_trends", "category_breakdown", "recipe_trend_alignment", "dietary_breakdown", "named_entities",
    }
    tone = {r.label: (r["count"], r.percentage) for r in serving.sentiment(facts).collect()}
    assert tone == {"positive": (2, 66.67), "negative": (1, 33.33)}
    words = {r.keyword: (r["rank"], r.score, r.sentiment) for r in serving.keywords(facts).collect()}
    assert words["ramen"] == (1, 100.0, "positive") and words["pizza"][2] == "negative"
    assert [(r.week, r.article_count) for r in serving.sentiment_trend(facts).collect()] == [("2026-05-25", 2)]
    assert [(r.date, r.articles) for r in serving.daily_volume(facts).collect()] == [("2026-05-26", 2)]
    assert [(r.name, r.mentions) for r in serving.entities(facts).collect()] == [("Ramen", 3)]
    row = serving.narrative_summary(facts).first()
    assert (row.top_keyword, row.pct_positive, row.recipe_count, row.top_diet) == ("ramen", 66, 3, "vegetarian")
    assert row.narrative.startswith("Talk of the week: ramen; 66%") and row.narrative.endswith("100.0% of recipes.")
    assert serving.positive_share(facts).first().pct_positive == 66
    assert serving.dominant_label(facts).first().label == "positive"
    pivot = {r.source: r for r in serving.source_metrics(facts).collect()}
    assert pivot["api_recipes"].record_count == 3.0 and pivot["web_articles"].avg_health_score is None
    assert [r.recipe_id for r in serving.trending_recipes(facts, 1).collect()] == ["1"]


def test_newest_run_only(spark):
    from trendlake.operators import profile
    df = spark.createDataFrame([(1,)], "id int")
    both = profile.record_count(df, "s", TS).union(profile.record_count(df.limit(0), "s", datetime(2026, 5, 28)))
    assert [r.value for r in serving.current(both).collect()] == [0.0]


def test_gold_dedupe_is_repeatable_and_tolerates_columns(spark):
    rows = spark.createDataFrame([(1, "b", True), (1, "a", False), (None, "n", None)], "id int, title string, vegan boolean")
    got = {r.id: (r.title, r.dietary_tags) for r in gold.gold_recipes(rows).collect()}
    assert got == {1: ("a", []), None: ("n", [])}
    assert gold.gold_articles(rows).columns == []


def test_streamed_ingest_drops_repeated_ids(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.json").write_text(json.dumps([article(1, "great ramen"), article(2, "bad pizza")]))
    rows = stream.stream_articles(spark, str(source), files_per_trigger=1)
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    for name, extra in (("one.json", None), ("two.json", [article(2, "again"), article(3, "new text")])):
        if extra:
            (source / name).write_text(json.dumps(extra))
        stream.start_ingest(rows, STOP, table, state).awaitTermination(120)
    got = {r.article_id: r.article_summary_clean for r in spark.read.parquet(table).collect()}
    assert got == {"a1": "great ramen", "a2": "bad pizza", "a3": "new text"}
    (source / "odd.json").write_text(json.dumps([article(9, "when?", date_extracted="yesterday")]))
    stream.start_ingest(rows, STOP, table, state).awaitTermination(120)
    stream.start_rejects(rows, str(tmp_path / "rejects"), str(tmp_path / "state2")).awaitTermination(120)
    assert [r.article_id for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["a9"]
    assert spark.read.parquet(table).count() == 3


def test_weekly_windows_start_on_monday(spark):
    df = spark.sql("select timestamp'2026-05-31 23:00:00' t, 0.5D compound_score union all select timestamp'2026-06-01 01:00:00', 0.1D")
    got = {str(r.week): r.avg_sentiment for r in stream.weekly_windows(df, "t").collect()}
    assert got == {"2026-05-25": 0.5, "2026-06-01": 0.1}


def test_schema_compliance_sees_landed_fields(spark, tmp_path):
    posts, dishes = tmp_path / "bronze/articles/dt=2026-05-27", tmp_path / "bronze/recipes/dt=2026-05-27"
    posts.mkdir(parents=True)
    dishes.mkdir(parents=True)
    short = {k: v for k, v in article(1, "great ramen").items() if k != "author"}
    (posts / "one.json").write_text("\n" + json.dumps([short, {**short, "article_id": "b", "mood": {"x": 1}}]))
    (posts / "bad.json").write_text('[{"source": ')
    (dishes / "r.json").write_text(json.dumps({"results": [recipe(1, "Ramen", newField=[{"title": 1}])]}))
    assert landed.field_names(spark, str(posts)) == {*short, "mood"}
    assert landed.field_names(spark, str(dishes), "results") == {*recipe(1, "Ramen"), "newField"}
    inputs = daily.Inputs(lexicon=spark.createDataFrame([("great", 3.1)], "token string, valence double"), stop_words=STOP)
    daily.run_daily(spark, str(tmp_path), inputs, TS)
    facts = spark.read.parquet(f"{tmp_path}/gold/governance").filter("kpi_name in ('schema_compliance_rate', 'unexpected_columns')")
    rows = {(r.kpi_name, r.source): r for r in facts.collect()}
    assert rows["schema_compliance_rate", "webscraping"].value < 100 and "author" in rows["schema_compliance_rate", "webscraping"].finding
    assert "mood" in rows["unexpected_columns", "webscraping"].finding
    assert "newField" in rows["unexpected_columns", "api"].finding


def test_ingest_remembers_ids_for_ever_and_replayed_batches_add_nothing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.json").write_text(json.dumps([article(1, "great ramen"), article(1, "same batch", date_extracted="20260527_090000")]))
    rows = stream.stream_articles(spark, str(source))
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    stream.start_ingest(rows, STOP, table, state).awaitTermination(120)
    (source / "later.json").write_text(json.dumps([article(1, "forty days on", date_extracted="20260706_080000"), article(2, "new", article_id=None)]))
    stream.start_ingest(rows, STOP, table, state).awaitTermination(120)
    got = {r.article_id: r.article_summary_clean for r in spark.read.parquet(table).collect()}
    assert got == {"a1": "great ramen", None: "new"}
    # All files once more, as after a failure between the write and the commit of a batch.
    stream.start_ingest(rows, STOP, table, str(tmp_path / "other")).awaitTermination(120)
    assert spark.read.parquet(table).count() == 2


def test_malformed_files_go_to_the_reject_table(spark, tmp_path):
    posts, dishes = tmp_path / "bronze/articles/dt=2026-05-27", tmp_path / "bronze/recipes/dt=2026-05-27"
    posts.mkdir(parents=True)
    dishes.mkdir(parents=True)
    (posts / "one.json").write_text(json.dumps([article(1, "great ramen")]))
    (posts / "bad.json").write_text('[{"source": ')
    (dishes / "r.json").write_text(json.dumps({"results": [recipe(1, "Ramen")]}))
    (dishes / "typed.json").write_text(json.dumps({"results": [{**recipe(2, "Pho"), "healthScore": "high"}]}))
    (dishes / "error.json").write_text(json.dumps({"status": "failure"}))
    (dishes / "html.json").write_text("<html>busy</html>")
    inputs = daily.Inputs(lexicon=spark.createDataFrame([("great", 3.1)], "token string, valence double"), stop_words=STOP)
    written = daily.run_daily(spark, str(tmp_path), inputs, TS)
    assert written["silver_articles"] == 1 and written["rejects"] == 4
    rejects = {r.source_file.split("/")[-1]: (r.source, r.reason) for r in spark.read.parquet(f"{tmp_path}/silver/rejects").collect()}
    assert rejects == {"bad.json": ("webscraping", "unreadable"), "typed.json": ("api", "partly read"), "error.json": ("api", "incomplete"), "html.json": ("api", "unreadable")}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/silver/recipes").collect()} == {1, 2}
    facts = spark.read.parquet(f"{tmp_path}/gold/governance").filter("kpi_name = 'rejected_payloads'").collect()
    assert sorted((r.source, r.field, r.value) for r in facts) == [("api", "incomplete", 1.0), ("api", "partly read", 1.0), ("api", "unreadable", 1.0), ("webscraping", "unreadable", 1.0)]
