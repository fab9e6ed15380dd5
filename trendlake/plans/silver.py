"""Landed rows to cleaned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions.nested import flatten_arrays, ingredient_names, instruction_text
from trendlake.functions.text import clean_text, remove_photo_credit, strip_html, unescape_html
from trendlake.functions.values import to_int
from trendlake.operators.dedupe import keep_first
from trendlake.sources.landed import POSITION, SOURCE_FILE


def clean_articles(articles: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """Decoded titles plus cleaned summary and title."""
    title = unescape_html(F.col("article_title"))
    return articles.withColumns({
        "article_title": title,
        "article_summary_clean": clean_text(remove_photo_credit(F.col("article_summary")), stop_words),
        "article_title_clean": clean_text(title, stop_words),
    })


def silver_articles(landed: DataFrame, stop_words: Sequence[str], key: str = "article_id") -> DataFrame:
    """One cleaned row per article; of copies the first file's first row stays."""
    first = keep_first(landed, [key], [SOURCE_FILE, POSITION]).drop(SOURCE_FILE, POSITION)
    return clean_articles(first, stop_words)


def silver_recipes(landed: DataFrame) -> DataFrame:
    """Flat recipe rows; copies of a recipe stay, they are removed in the curated table."""
    flat = landed.withColumns({
        "preparationMinutes": to_int(F.col("preparationMinutes")),
        "cookingMinutes": to_int(F.col("cookingMinutes")),
        "ingredient_names": ingredient_names(F.col("extendedIngredients")),
        "instructions_text": instruction_text(F.col("analyzedInstructions")),
        "summary": F.when(F.col("summary").isNotNull(), strip_html(F.col("summary"))),
    })
    return flatten_arrays(flat).drop(SOURCE_FILE)
