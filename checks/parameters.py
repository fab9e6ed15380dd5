"""Query parameters shared by the Spark queries and the SQL: words that occur in the tables."""

from datetime import date, datetime

RUN_TS = datetime(2026, 5, 27, 12, 0, 0)
TODAY = date(1998, 8, 2)

STOP_WORDS = ["the", "of", "and", "a", "to", "in", "is", "de", "la", "der", "die", "und", "en"]
LEXICON = {
    "that": 1.9, "with": 2.3, "was": -1.8, "for": 0.9, "on": -0.7, "les": -1.3, "des": 1.1, "que": 0.6,
    "mit": -2.2, "von": 1.4, "los": 1.7, "orre": -3.1, "from": 0.4, "ha": -0.9,
}
BOOSTERS = {"this": 0.293, "tion": 0.293, "un": 0.293, "ing": -0.293, "das": -0.293, "th": -0.293}
NEGATIONS = ["it", "et", "nd", "sich"]
VOCABULARY = ["that", "with", "ononst", "thatin", "eaux", "nicht", "orantion", "zu", "el", "absent"]
GAZETTEER = [
    ("the", "restaurant"), ("of the", "restaurant"), ("was the", "restaurant"), ("that", "restaurant"),
    ("de la", "neighborhood"), ("des", "neighborhood"), ("und die", "neighborhood"),
    ("the rewh", "chef"), ("von der", "chef"), ("mit", "chef"), ("it", "chef"),
]
TARGETS = ["CHINA", "FRANCE", "ATLANTIS", "NATION_3", "NATION_7", "NATION_24", "NATION_99"]
SEARCH_WORDS = ["red", "bolt", "ring", "economy", "promo", "absent"]
INGREDIENTS = ["widget", "ring", "bolt", "red", "absent"]
EXPECTED_COLUMNS = ["doc_id", "text", "lang", "source", "title", "author"]
SEED_LABEL = 3
COSINE = 0.1
