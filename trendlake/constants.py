"""Word lists, column lists and thresholds."""

from __future__ import annotations

# Words that carry no signal in a food-news corpus. Removed from
# cleaned text together with the language's stop words.
DOMAIN_STOP_WORDS = [
    "eater", "eaterland", "nyc", "ny",
    "recipe", "recipes", "restaurant", "restaurants",
    "new york", "york",
]

# Seed words whose mean vector is the topic anchor.
ANCHOR_SEEDS = [
    "pizza", "pasta", "sushi", "chicken", "wine", "steak", "burger",
    "dessert", "cuisine", "ingredient", "seafood", "spice", "cocktail",
    "cheese", "ramen", "taco", "salmon", "mushroom", "chocolate", "coffee",
    "italian", "japanese", "french", "mexican", "thai", "korean",
    "culinary", "gastronomy", "dish", "recipe", "flavor", "cook",
]

# Terms accepted whatever their vector says.
TOPIC_VOCABULARY = [
    "italian", "japanese", "mexican", "french", "chinese", "korean",
    "thai", "indian", "greek", "spanish", "peruvian", "lebanese",
    "vietnamese", "ethiopian", "moroccan", "turkish", "caribbean",
    "mediterranean", "latin", "american",
    "omakase", "kaiseki", "izakaya", "tapas", "mezze",
    "birria", "khachapuri", "tiradito",
    "vegan", "vegetarian", "brunch", "tasting",
]

# Ingredients a complete collection covers.
TARGET_INGREDIENTS = [
    "truffle", "lobster", "foie gras", "caviar", "wagyu beef", "saffron",
    "vanilla bean", "champagne", "artisanal cheese", "heirloom tomato",
    "microgreens", "sea urchin", "black truffle", "oyster", "sake", "matcha",
    "espresso", "artichoke", "fennel",
]

# Columns of the two curated tables, in output order.
RECIPE_COLUMNS = [
    "id", "title", "summary", "image", "readyInMinutes", "servings",
    "vegetarian", "vegan", "glutenFree", "dairyFree", "veryHealthy",
    "healthScore", "spoonacularScore", "pricePerServing",
    "cuisines", "dishTypes", "diets", "sourceUrl", "sourceName",
    "aggregateLikes", "ingredient_names", "instructions_text",
]
ARTICLE_COLUMNS = [
    "article_id", "article_title", "article_title_clean", "article_url",
    "article_summary_clean", "categories", "published_date", "source", "author",
]

# Columns the serving queries show for a recipe.
RECIPE_DISPLAY_COLUMNS = [
    "id", "title", "image", "summary", "readyInMinutes", "servings",
    "pricePerServing", "cuisines", "dishTypes", "diets",
    "vegetarian", "vegan", "glutenFree", "dairyFree",
    "ingredient_names", "instructions_text",
    "spoonacularScore", "healthScore", "aggregateLikes", "sourceUrl",
]

# Columns a source must have to be schema compliant.
EXPECTED_RECIPE_COLUMNS = [c for c in RECIPE_COLUMNS if c not in ("ingredient_names", "instructions_text")]
EXPECTED_ARTICLE_COLUMNS = ARTICLE_COLUMNS

# Which columns each profile measures.
RECIPE_NUMERIC_COLUMNS = ["readyInMinutes", "healthScore", "spoonacularScore", "pricePerServing", "aggregateLikes"]
RECIPE_TEXT_COLUMNS = ["summary"]
ARTICLE_TEXT_COLUMNS = ["article_summary", "article_summary_clean"]

# Flag column -> tag, flag column -> display name.
DIETARY_TAGS = {
    "vegetarian": "vegetarian",
    "vegan": "vegan",
    "glutenFree": "gluten_free",
    "dairyFree": "dairy_free",
}
DIETARY_LABELS = {
    "vegetarian": "Vegetarian",
    "vegan": "Vegan",
    "glutenFree": "Gluten-free",
    "dairyFree": "Dairy-free",
    "veryHealthy": "Very healthy",
}

# Thresholds and sizes.
POSITIVE_FROM = 0.05
NEGATIVE_UP_TO = -0.05
COSINE_THRESHOLD = 0.35
MIN_TOPIC_KEYWORDS = 3
MAX_FEATURES = 500
FEED_ITEM_CAP = 20
RETENTION_DAYS = 30
LOCATION_FOCUS = "New York City"

# Fixed values of the published rule-based sentiment method (Hutto & Gilbert 2014):
# intensifiers and dampeners (+/- one step), negations, and the rule constants.
BOOSTER_STEP = 0.293
INTENSIFIERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerably",
    "decidedly", "deeply", "effing", "enormously", "entirely", "especially",
    "exceptionally", "extremely", "fabulously", "flipping", "flippin",
    "fricking", "frickin", "frigging", "friggin", "fully", "fucking",
    "greatly", "hella", "highly", "hugely", "incredibly", "intensely",
    "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "totally",
    "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
]
DAMPENERS = [
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little",
    "marginally", "occasionally", "partly", "scarcely", "slightly",
    "somewhat", "sorta", "sortof",
]
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt",
    "doesnt", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt",
    "mustnt", "neither", "neednt", "never", "none", "nope", "nor", "not",
    "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt",
    "werent", "without", "wont", "wouldnt", "rarely", "seldom", "despite",
]
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = [1.0, 0.95, 0.9]
NORMALISATION_ALPHA = 15.0
