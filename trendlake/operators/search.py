"""Recipe search over a recipe table: by keyword, by ingredient, by filters, by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.constants import RECIPE_DISPLAY_COLUMNS
from trendlake.functions.values import fill_text, select_present
from trendlake.operators.substring import per_term


def _best_per_query(hits: DataFrame, number: int) -> DataFrame:
    """At most ``number`` hits per query; the limit is applied before the shuffle too."""
    order = Window.partitionBy("query").orderBy(F.desc_nulls_last("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= number)


def _details(best: DataFrame, recipes: DataFrame) -> DataFrame:
    """Full rows of the hits; where the hits (queries x number) are few, Spark does not move the recipes."""
    return recipes.join(best.select("query", "rank", "id"), "id").select("query", "rank", *recipes.columns)


def search_by_keywords(
    keywords: DataFrame, recipes: DataFrame, columns: Sequence[str], number: int = 5, score: str = "spoonacularScore"
) -> DataFrame:
    """The ``number`` best recipes whose text contains each keyword (``term``); keywords without hits give no row.

    Keywords are compared in lower case; equal ones are one query, empty ones none.
    """
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    narrow = recipes.select("id", F.col(score).alias("score"), text.alias("_text"))

    def best(hits: DataFrame) -> DataFrame:
        return _best_per_query(hits.withColumnRenamed("term", "query"), number).withColumnRenamed("query", "term")

    in_order = narrow.sortWithinPartitions(F.desc_nulls_last("score"), "id")
    found = per_term(in_order, "_text", keywords.select(F.lower("term").alias("term")), best, first=number)
    return _details(found.withColumnRenamed("term", "query"), recipes)


def as_list(df: DataFrame, column: str) -> Column:
    """A list column, or CSV text, as an array of trimmed lower-case text."""
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, T.ArrayType):
        value = F.split(value, ",")
    return F.transform(value, lambda v: F.lower(F.trim(v)))


def diet_matches(diets: Column, diet: str) -> Column:
    """``a,b`` asks for all, ``a|b`` for any; no restriction is always met."""
    if not diet:
        return F.lit(True)
    wanted = [d.strip().lower() for d in diet.replace("|", ",").split(",")]
    found = [F.array_contains(diets, d) for d in wanted]
    if "|" in diet:
        return F.coalesce(F.arrays_overlap(diets, F.array(*[F.lit(d) for d in wanted])), F.lit(False))
    condition = found[0]
    for other in found[1:]:
        condition = condition & other
    return F.coalesce(condition, F.lit(False))


def search_by_ingredients(
    ingredients: Sequence[str],
    recipes: DataFrame,
    number: int = 10,
    diet: str = "",
    intolerances: str = "",
    ingredient_column: str = "ingredient_names",
    diet_column: str = "diets",
    score: str = "spoonacularScore",
) -> DataFrame:
    """The ``number`` best recipes that use each ingredient and meet the diet.

    An intolerance to x asks for the diet ``x free``.
    """
    used = as_list(recipes, ingredient_column)
    diets = as_list(recipes, diet_column)
    free = ",".join(f"{x.strip()} free" for x in intolerances.split(",") if x.strip())
    allowed = recipes.filter(diet_matches(diets, diet) & diet_matches(diets, free))
    wanted = F.array(*[F.lit(i.lower()) for i in ingredients])
    hits = allowed.select(F.explode(F.array_intersect(wanted, used)).alias("query"), "id", F.col(score).alias("score"))
    return _details(_best_per_query(hits, number), recipes)


def missing_keys(requested: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Requested keys that are not stored yet."""
    return requested.join(stored.select(key), key, "left_anti")


def recipe_list(
    recipes: DataFrame,
    limit: int = 20,
    cuisine: str | None = None,
    diet: str | None = None,
    max_minutes: int | None = None,
    score: str = "spoonacularScore",
) -> DataFrame:
    """Filtered recipes by score with ``rank`` and the ``total`` before the limit (1..100)."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must lie between 1 and 100")
    shown = select_present(recipes, RECIPE_DISPLAY_COLUMNS)
    if cuisine:
        shown = shown.filter(F.contains(F.lower("cuisines"), F.lit(cuisine.lower())))
    if diet and diet in shown.columns:
        shown = shown.filter(F.col(diet))
    if max_minutes is not None and "readyInMinutes" in shown.columns:
        shown = shown.filter(F.col("readyInMinutes") <= max_minutes)
    total = shown.agg(F.count("*"))
    best = shown.orderBy(F.desc_nulls_last(score), "id").limit(limit)
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last(score), "id"))
    return fill_text(best.withColumn("rank", place)).withColumn("total", total.scalar())


def recipe_by_id(recipes: DataFrame, recipe_id: int) -> DataFrame:
    """One recipe, or no row; the id reaches the file scan as a pushed filter."""
    return fill_text(select_present(recipes, RECIPE_DISPLAY_COLUMNS).filter(F.col("id") == recipe_id))
