"""Sentiment, volume and category aggregations in the storytelling schema."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.constants import DIETARY_LABELS, POSITIVE_FROM
from trendlake.functions.lookup import let
from trendlake.functions.text import is_number, tokens_of
from trendlake.functions.values import half_up, percent, positive_or_not, present_columns, published_date
from trendlake.operators.keywords import ranked
from trendlake.operators.longform import long_rows, story_row
from trendlake.operators.substring import FEW, few_rows, with_terms


def sentiment_counts(scored: DataFrame) -> DataFrame:
    """``sentiment_label``, ``n``, ``percentage`` and the overall sum of scores."""
    per_label = scored.groupBy("sentiment_label").agg(F.count("*").alias("n"), F.sum("compound_score").alias("s"))
    whole = Window.partitionBy()
    return (
        per_label.withColumn("all_", F.sum("n").over(whole))
        .withColumn("percentage", percent(F.col("n"), F.col("all_")))
        .withColumn("mean", F.sum("s").over(whole) / F.col("all_"))
    )


def sentiment_distribution(scored: DataFrame, run_ts: datetime) -> DataFrame:
    """Count and share per label, and the overall mean score once."""
    first = F.row_number().over(Window.orderBy("sentiment_label")) == 1
    counts = sentiment_counts(scored).withColumn("first", first)
    name = ("sentiment_distribution", "sentiment")
    rows = [
        story_row(*name, "sentiment_label", F.col("sentiment_label"), "count", F.col("n"),
                  F.concat(F.col("percentage").cast("string"), F.lit("% of articles"))),
        story_row(*name, "sentiment_label", F.col("sentiment_label"), "percentage", F.col("percentage"),
                  F.format_string("%d articles", "n")),
        F.when(F.col("first"), story_row(*name, "overall", "all", "avg_compound_score",
                                         half_up(F.coalesce("mean", F.lit(0.0)), 4), "mean score")),
    ]
    return long_rows(counts, rows, run_ts)


def with_published_date(df: DataFrame, column: str = "published_date") -> DataFrame:
    """Rows whose publication date parses, with ``pub_date``."""
    kind = df.schema[column].dataType
    date = published_date(F.col(column)) if isinstance(kind, T.StringType) else F.to_date(column)
    return df.withColumn("pub_date", date).filter(F.col("pub_date").isNotNull())


def weekly_sentiment(scored: DataFrame, column: str = "published_date") -> DataFrame:
    """``week`` (Monday), mean score and article count."""
    week = F.date_trunc("week", "pub_date").alias("week")
    return (
        with_published_date(scored, column).groupBy(week)
        .agg(F.avg("compound_score").alias("mean"), F.count("*").alias("n"))
    )


def sentiment_trend(scored: DataFrame, run_ts: datetime, column: str = "published_date") -> DataFrame:
    week = F.date_format("week", "yyyy-MM-dd HH:mm:ss")
    name = ("sentiment_trend", "temporal", "week", week)
    rows = [
        story_row(*name, "avg_sentiment", half_up(F.coalesce("mean", F.lit(0.0)), 4), F.format_string("%d articles", "n")),
        story_row(*name, "article_count", F.col("n"), week),
    ]
    return long_rows(weekly_sentiment(scored, column), rows, run_ts)


def volume_trends(df: DataFrame, run_ts: datetime, column: str = "published_date") -> DataFrame:
    daily = with_published_date(df, column).groupBy("pub_date").agg(F.count("*").alias("n"))
    row = story_row("volume_trends", "temporal", "date", F.col("pub_date"), "article_count", F.col("n"), F.col("pub_date"))
    return long_rows(daily, [row], run_ts)


def category_values(df: DataFrame, column: str) -> Column:
    """Categories as an array, from an array column or from CSV text."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} is required")
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return F.col(column)
    return F.split(column, ",")


def category_counts(scored: DataFrame, column: str = "categories") -> DataFrame:
    exploded = scored.select(
        F.explode(category_values(scored, column)).alias("cat"), "compound_score", "sentiment_label"
    )
    return (
        exploded.withColumn("cat", F.trim("cat")).filter(F.col("cat") != "").groupBy("cat").agg(
            F.count("*").alias("n"), F.avg("compound_score").alias("mean"),
            F.count_if(F.col("sentiment_label") == "positive").alias("positive"),
            F.count_if(F.col("sentiment_label") == "negative").alias("negative"),
        )
    )


def category_breakdown(scored: DataFrame, run_ts: datetime, column: str = "categories") -> DataFrame:
    mean = F.coalesce("mean", F.lit(0.0))
    name = ("category_breakdown", "content", "category", F.col("cat"))
    rows = [
        story_row(*name, "article_count", F.col("n"), F.col("cat")),
        story_row(*name, "avg_sentiment", half_up(mean, 4), positive_or_not(mean)),
        story_row(*name, "positive_count", F.col("positive"), F.col("cat")),
        story_row(*name, "negative_count", F.col("negative"), F.col("cat")),
    ]
    return long_rows(category_counts(scored, column), rows, run_ts)


def flag_breakdown(df: DataFrame, run_ts: datetime, labels: Mapping[str, str] = DIETARY_LABELS) -> DataFrame:
    """Count and share of rows where each flag is true, all flags in one pass."""
    flags = present_columns(df, labels)
    wide = df.agg(F.count("*").alias("rows_"), *[F.count_if(F.col(c)).alias(f"n_{c}") for c in flags])
    rows = []
    for flag in flags:
        n, share = F.col(f"n_{flag}"), percent(F.col(f"n_{flag}"), F.col("rows_"))
        name = ("dietary_breakdown", "recommendation", "dietary_flag", flag)
        shown = F.concat(F.lit(f"{labels[flag]}: "), share.cast("string"), F.lit("% of recipes"))
        rows += [story_row(*name, "count", n, shown), story_row(*name, "percentage", share, labels[flag])]
    return long_rows(wide.filter(F.col("rows_") > 0), rows, run_ts)


def source_comparison(
    scored: DataFrame, recipes: DataFrame, run_ts: datetime,
    article_label: str = "web articles", recipe_label: str = "recipes",
) -> DataFrame:
    """Means and record counts of the two sources."""
    def rounded(name: str) -> Column:
        return half_up(F.coalesce(name, F.lit(0.0)), 4)

    articles = scored.agg(F.avg("compound_score").alias("mean"), F.count("*").alias("n"))
    name = ("source_comparison", "cross_source", "source")
    article_rows = [
        story_row(*name, "web_articles", "avg_sentiment", rounded("mean"), F.format_string(f"%d {article_label}", "n")),
        story_row(*name, "web_articles", "record_count", F.col("n"), article_label),
    ]
    dishes = recipes.agg(
        F.avg("spoonacularScore").alias("score"), F.avg("healthScore").alias("health"), F.count("*").alias("n")
    )
    counted = F.format_string(f"%d {recipe_label}", "n")
    recipe_rows = [
        story_row(*name, "api_recipes", "avg_spoonacular_score", rounded("score"), counted),
        story_row(*name, "api_recipes", "avg_health_score", rounded("health"), counted),
        story_row(*name, "api_recipes", "record_count", F.col("n"), recipe_label),
    ]
    return long_rows(articles, article_rows, run_ts).unionByName(long_rows(dishes, recipe_rows, run_ts))


def buzz_words(scored: DataFrame, text: str, top_n: int = 20) -> DataFrame:
    """Most frequent longer words of the positive documents, or of all when none is positive."""
    positive = F.coalesce(F.col("compound_score") >= POSITIVE_FROM, F.lit(False))
    any_positive = scored.agg(F.coalesce(F.max(positive), F.lit(False))).scalar()
    used = scored.filter(positive | ~any_positive)
    words = used.select(tokens_of(F.col(text)).alias("words")).select(F.explode("words").alias("term"))
    counted = (
        words.filter((F.length("term") > 3) & ~is_number(F.col("term")))
        .groupBy("term").agg(F.count("*").alias("n"))
    )
    return ranked(counted, top_n, "n").select("rank", "term", "n")


def match_words(df: DataFrame, columns: list[str], words: DataFrame, few: int = FEW) -> DataFrame:
    """``df`` plus ``matches``: the listed words found as substrings of the columns, in rank order.

    A short list is looked for in place. With a longer one, each different text's matches
    are found once and joined back.
    """
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    rows, listed = few_rows(words, few), words.select("rank", "term")
    if rows is not None:
        terms = F.array(*(F.lit(r["term"]) for r in sorted(rows, key=lambda r: (r["rank"], r["term"])) if r["term"])).cast("array<string>")
        return df.withColumn("matches", let(text, lambda body: F.filter(terms, lambda t: F.contains(body, t))))
    with_text = df.withColumn("_text", text)
    hits = with_terms(with_text.select("_text").distinct(), "_text", listed, few)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    found = hits.groupBy("_text").agg(F.transform(ordered, lambda w: w["term"]).alias("matches"))
    none = F.array().cast("array<string>")
    return with_text.join(found, "_text", "left").withColumn("matches", F.coalesce("matches", none)).select(*df.columns, "matches")


def trend_alignment(recipes: DataFrame, words: DataFrame, run_ts: datetime) -> DataFrame:
    """Per recipe: matched words, score, likes; with a short list rows stay where they are."""
    matched = match_words(
        recipes.select("id", "title", "cuisines", "dishTypes", "spoonacularScore", "aggregateLikes"),
        ["title", "cuisines", "dishTypes"], words,
    )
    name = ("recipe_trend_alignment", "recommendation", "recipe_id", F.col("id"))
    n = F.size("matches")
    rows = [
        story_row(*name, "trend_score", n, F.col("title")),
        story_row(*name, "spoonacular_score", F.coalesce(F.col("spoonacularScore").cast("double"), F.lit(0.0)), F.col("title")),
        story_row(*name, "aggregate_likes", F.coalesce(F.col("aggregateLikes").cast("double"), F.lit(0.0)), F.col("title")),
        F.when(n > 0, story_row(*name, "matched_keywords", n, F.array_join(F.slice("matches", 1, 5), "|"))),
    ]
    return long_rows(matched, rows, run_ts)
