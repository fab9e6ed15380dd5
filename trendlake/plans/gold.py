"""Curated tables: allow-listed columns, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trendlake.constants import ARTICLE_COLUMNS, DIETARY_TAGS, RECIPE_COLUMNS
from trendlake.functions.nested import flag_tags
from trendlake.functions.values import columns_of, select_present
from trendlake.operators.dedupe import keep_first


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Any copy would do; ordering by the other scalar columns makes the choice repeatable."""
    if key not in df.columns:
        return df
    others = [c for c in columns_of(df, "scalar") if c != key]
    return keep_first(df, [key], others or [key])


def gold_recipes(silver: DataFrame) -> DataFrame:
    kept = _one_per_key(select_present(silver, RECIPE_COLUMNS), "id")
    flags = {c: tag for c, tag in DIETARY_TAGS.items() if c in kept.columns}
    return kept.withColumn("dietary_tags", flag_tags(flags)) if flags else kept


def gold_articles(silver: DataFrame) -> DataFrame:
    return _one_per_key(select_present(silver, ARTICLE_COLUMNS), "article_id")
