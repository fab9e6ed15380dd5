"""Declared schemas of landed files; nested JSON is never inferred."""

from __future__ import annotations

_NAMED = "array<struct<id: bigint, name: string, localizedName: string, image: string>>"
_MEASURE = "struct<amount: double, unitShort: string, unitLong: string>"

_INGREDIENT = (
    "struct<id: bigint, aisle: string, image: string, consistency: string, name: string, nameClean: string, "
    "original: string, originalName: string, amount: double, unit: string, meta: array<string>, "
    f"measures: struct<us: {_MEASURE}, metric: {_MEASURE}>>"
)
_STEP = (
    f"struct<number: int, step: string, ingredients: {_NAMED}, equipment: {_NAMED}, "
    "length: struct<number: int, unit: string>>"
)

# Times and license arrive as numbers in some files and as text in others: read as text.
_RECIPE = (
    "id: bigint, image: string, imageType: string, title: string, readyInMinutes: int, servings: int, "
    "sourceUrl: string, vegetarian: boolean, vegan: boolean, glutenFree: boolean, dairyFree: boolean, "
    "veryHealthy: boolean, cheap: boolean, veryPopular: boolean, sustainable: boolean, lowFodmap: boolean, "
    "weightWatcherSmartPoints: int, gaps: string, preparationMinutes: string, cookingMinutes: string, "
    "aggregateLikes: int, healthScore: double, creditsText: string, license: string, sourceName: string, "
    f"pricePerServing: double, extendedIngredients: array<{_INGREDIENT}>, summary: string, "
    "cuisines: array<string>, dishTypes: array<string>, diets: array<string>, occasions: array<string>, "
    f"instructions: string, analyzedInstructions: array<struct<name: string, steps: array<{_STEP}>>>, "
    "language: string, spoonacularScore: double, spoonacularSourceUrl: string, description: string"
)

RECIPE_FILE = f"results array<struct<{_RECIPE}>>, totalResults int"

ARTICLE_FILE = (
    "source string, article_title string, article_url string, article_id string, author string, "
    "article_summary string, categories array<string>, location_focus string, published_date string, "
    "date_extracted string"
)

RSS_ITEM = (
    "title string, link string, guid string, `dc:creator` string, pubDate string, "
    "`content:encoded` string, description string, category array<string>"
)

ATOM_ENTRY = (
    "title string, id string, author struct<name: string>, published string, updated string, "
    "link array<struct<_rel: string, _href: string>>, content string, summary string, "
    "category array<struct<_term: string>>"
)
