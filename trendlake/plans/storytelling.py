"""The storytelling fact table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from trendlake.functions.values import select_present
from trendlake.operators import trends
from trendlake.operators.entities import named_entities
from trendlake.operators.keywords import keyword_sentiment, ranked, tfidf_scores, top_bigrams, top_keywords, topic_terms
from trendlake.session import written_once
from trendlake.sources.drift import union_all

TEXT = "article_summary_clean"


def storytelling_facts(
    scored: DataFrame,
    recipes: DataFrame,
    run_ts: datetime,
    vocabulary: Sequence[str] | None = None,
    vectors: DataFrame | None = None,
    seeds: Sequence[str] = (),
    gazetteer: DataFrame | None = None,
    folder: str | None = None,
) -> DataFrame:
    """All aggregations over scored articles and recipes.

    ``scored`` comes from ``add_sentiment``. Its needed columns are written once (to
    ``folder``, or the shared one), as every aggregation reads them.
    """
    needed = [TEXT, "article_title", "categories", "published_date", "compound_score", "sentiment_label"]
    scored = written_once(select_present(scored, needed), folder)
    scores = tfidf_scores(scored, TEXT)
    if vocabulary is not None:
        scores = scores.join(topic_terms(scores, vocabulary, vectors, seeds), "term", "left_semi")
    # A top list of bounded size, computed once for both keyword aggregations.
    best = ranked(scores, 20, "score").select("rank", "term", "score").collect()
    terms = scored.sparkSession.createDataFrame(best, "rank int, term string, score double")
    parts = [
        trends.sentiment_distribution(scored, run_ts),
        trends.sentiment_trend(scored, run_ts),
        top_keywords(terms, run_ts),
        top_bigrams(scored, TEXT, run_ts),
        keyword_sentiment(scored, TEXT, terms.filter("rank <= 15"), run_ts),
        trends.source_comparison(scored, recipes, run_ts),
        trends.volume_trends(scored, run_ts),
        trends.category_breakdown(scored, run_ts),
        trends.trend_alignment(recipes, trends.buzz_words(scored, TEXT), run_ts),
        trends.flag_breakdown(recipes, run_ts),
    ]
    if gazetteer is not None and "article_title" in scored.columns:
        parts.append(named_entities(scored, "article_title", gazetteer, run_ts))
    return union_all(parts)
