"""Properties of the physical plans that matter at scale."""

import os

from pyspark.sql import functions as F

from trendlake.operators import dedupe, entities, search, sentiment
from trendlake.operators.quantiles import exact_quantiles
from trendlake.session import work_folder, written_once


def plan(df):
    return df._jdf.queryExecution().toString()


def recipes(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("spoonacularScore")
    )


def test_point_lookup_is_pushed_to_the_scan(spark, sf_dir):
    text = plan(search.recipe_by_id(recipes(spark, sf_dir), 7))
    assert "EqualTo(p_partkey,7)" in text and "Exchange" not in text


def test_search_limits_hits_before_the_shuffle(spark, sf_dir):
    terms = spark.createDataFrame([("red",), ("bolt",)], "term string")
    text = plan(search.search_by_keywords(terms, recipes(spark, sf_dir), ["title"], 5))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sentiment_moves_no_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lexicon = spark.createDataFrame([("that", 1.0)], "token string, valence double")
    text = plan(sentiment.add_sentiment(docs, "text", lexicon))
    assert "Exchange" not in text and "Python" not in text


def test_dedupe_reduces_before_the_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(dedupe.keep_first(docs, ["text"], ["doc_id"]))
    assert "partial_min_by" in text and "Window" not in text


def test_hot_key_keeps_every_result(spark):
    """A third of the rows share one key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id", F.lit("of the").alias("text")
    )
    kept = dedupe.keep_first(df, ["k"], ["id"])
    assert kept.count() == 20_001 and kept.filter("k = -1").first().id == 0
    assert dedupe.key_duplicates(df, "k").first().duplicates == 9_999
    names = spark.createDataFrame([("the", "x"), ("of the", "y")], "name string, entity_type string")
    counts = {r.name: r.mentions for r in entities.entity_counts(df, "text", names).collect()}
    assert counts == {"the": 30_000, "of the": 30_000}


def test_shared_table_lies_in_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = written_once(spark.range(3))
    assert df.count() == 3 and all(folder in f for f in df.inputFiles())


def test_work_folder_is_deleted_at_the_end(spark):
    with work_folder(spark) as folder:
        assert written_once(spark.range(3), folder).count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_quantiles_take_few_jobs(spark, sf_dir):
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "")
    exact_quantiles(lines, columns, [0.25, 0.75])
    exact_jobs = len(tracker.getJobIdsForGroup("quantiles"))
    spark.sparkContext.setJobGroup("other", "")
    assert exact_jobs <= 9  # four passes; the last two stages of a pass are separate jobs under adaptive execution


def test_dedupe_exchanges_no_text_as_key(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (dedupe.keep_first(docs, ["text"], ["doc_id"]), dedupe.key_duplicates(docs, "text")):
        keys = [line for line in plan(df).splitlines() if "hashpartitioning(" in line]
        assert keys and all("hashpartitioning(text" not in line for line in keys)
