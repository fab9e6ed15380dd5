"""SQL side of the registered queries, written independently of the library."""

from __future__ import annotations

from checks import parameters as q
from trendlake.constants import EXPECTED_ARTICLE_COLUMNS, EXPECTED_RECIPE_COLUMNS, RECIPE_NUMERIC_COLUMNS


def _list(words) -> str:
    return "(" + ", ".join("'" + w + "'" for w in words) + ")"


def _r(x: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(floor(({x})::DOUBLE * {scale} + 0.5) / {scale})"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _r(f"({part})::DOUBLE / ({whole}) * 100", digits)


def _label(x: str) -> str:
    return f"CASE WHEN {x} >= 0.05 THEN 'positive' WHEN {x} <= -0.05 THEN 'negative' ELSE 'neutral' END"


DIGITS = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]+"


def _normal(x: str) -> str:
    return (
        f"trim(regexp_replace(lower(regexp_replace({x}, 'https?://\\S+|www\\.\\S+', ' ', 'g')), "
        r"'[^\p{L}\p{N}_]+', ' ', 'g'))"
    )


def _tokens(x: str, stop=tuple(q.STOP_WORDS)) -> str:
    dropped = f" AND w NOT IN {_list(stop)}" if stop else ""
    return (
        f"list_filter(string_split({_normal(x)}, ' '), "
        f"lambda w: length(w) > 1 AND NOT regexp_full_match(w, '{DIGITS}'){dropped})"
    )


def _no_credit(x: str) -> str:
    return rf"regexp_replace({x}, '^.{{0,300}}? \| \S+(?:\s\S+){{0,2}} ([A-Z])', '\1')"


ARTICLES = rf"""
raw AS (
  SELECT doc_id AS article_id, regexp_extract(text, '^[^.\n]*') AS article_title, text AS article_summary,
         source || ',' || lang AS categories, source, lang AS author FROM documents),
words AS (
  SELECT *, {_tokens(_no_credit('article_summary'))} AS toks, {_tokens('article_title')} AS title_toks FROM raw),
articles AS (
  SELECT *, array_to_string(toks, ' ') AS clean, array_to_string(title_toks, ' ') AS title_clean FROM words)
"""


def _step(n: int, damping: float) -> str:
    value = "valence" if n == 1 else f"v{n - 1}"
    boost = "CASE " + " ".join(f"WHEN p{n} = '{w}' THEN {b}" for w, b in q.BOOSTERS.items()) + " ELSE 0 END"
    sign = f"CASE WHEN {value} < 0 THEN -1 ELSE 1 END"
    flip = f"CASE WHEN p{n} IN {_list(q.NEGATIONS)} THEN -0.74 ELSE 1 END"
    known = f"p{n} IS NULL OR p{n} IN {_list(q.LEXICON)}"
    moved = f"({value} + ({boost})::DOUBLE * ({sign}) * {damping}::DOUBLE) * ({flip})::DOUBLE"
    source = "hits" if n == 1 else f"step{n - 1}"
    return f"step{n} AS (SELECT *, CASE WHEN {known} THEN {value} ELSE {moved} END AS v{n} FROM {source})"


SCORED = ARTICLES + rf""",
lexicon(token, valence) AS (VALUES {", ".join(f"('{w}', {v}::DOUBLE)" for w, v in q.LEXICON.items())}),
tok AS (SELECT article_id, unnest(toks) AS w, unnest(range(1, len(toks) + 1)) AS i FROM articles),
ctx AS (
  SELECT *, lag(w, 1) OVER p AS p1, lag(w, 2) OVER p AS p2, lag(w, 3) OVER p AS p3
  FROM tok WINDOW p AS (PARTITION BY article_id ORDER BY i)),
hits AS (SELECT ctx.*, valence FROM ctx JOIN lexicon ON w = token WHERE w NOT IN {_list(q.BOOSTERS)}),
{_step(1, 1.0)}, {_step(2, 0.95)}, {_step(3, 0.9)},
totals AS (SELECT article_id, sum(v3) AS s FROM step3 GROUP BY 1),
compound AS (
  SELECT a.*, {_r('coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15)', 4)} AS compound_score
  FROM articles a LEFT JOIN totals USING (article_id)),
scored AS (SELECT *, {_label('compound_score')} AS sentiment_label FROM compound),
dated AS (SELECT s.*, e.ts FROM scored s JOIN events e ON e.event_id = s.article_id)
"""


_LEXICON_ROWS = f"lexicon(token, valence) AS (VALUES {', '.join(f'({chr(39)}{w}{chr(39)}, {v}::DOUBLE)' for w, v in q.LEXICON.items())})"
_ALL_WORDS = (
    "lexicon AS (SELECT token, ((length(token) * 7) % 41 - 20) / 4.0::DOUBLE AS valence "
    "FROM (SELECT DISTINCT unnest(toks) AS token FROM articles) WHERE length(token) % 3 <> 0)"
)
SCORED_LARGE = SCORED.replace(_LEXICON_ROWS, _ALL_WORDS).replace(f"IN {_list(q.LEXICON)}", "IN (SELECT token FROM lexicon)")


def _tfidf(text: str = "clean", size: int = 500) -> str:
    return rf"""
corpus AS (SELECT article_id, {text} AS body FROM articles WHERE trim({text}) <> ''),
size AS (SELECT count(*) AS n FROM corpus),
terms AS (SELECT article_id, unnest(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM corpus),
vocab AS (
  SELECT term, count(*) AS total, count(DISTINCT article_id) AS df FROM terms
  GROUP BY 1 ORDER BY total DESC, term LIMIT {size}),
weights AS (
  SELECT article_id, term, any_value(total) AS total, count(*) * (ln((1 + any_value(n)) / (1 + any_value(df))) + 1) AS x
  FROM terms JOIN vocab USING (term), size GROUP BY 1, 2),
lengths AS (SELECT article_id, sqrt(sum(x * x)) AS z FROM weights GROUP BY 1),
scores AS (
  SELECT term, any_value(total)::BIGINT AS total, sum(x / z) / (SELECT n FROM size) AS score
  FROM weights JOIN lengths USING (article_id) GROUP BY 1)
"""


RECIPES = """
recipes AS (
  SELECT p_partkey AS id, p_name AS title, p_type AS cuisines, p_brand AS dishTypes, p_retailprice AS spoonacularScore,
         p_size * 2.0::DOUBLE AS healthScore, p_size % 17 AS aggregateLikes, p_size AS readyInMinutes,
         CASE WHEN p_size > 5 THEN p_size <= 20 END AS vegetarian, p_size <= 10 AS vegan, p_size % 3 = 0 AS glutenFree,
         p_size % 4 = 0 AS dairyFree, p_size > 45 AS veryHealthy, replace(p_name, ' ', ', ') AS ingredient_names,
         array_to_string(list_filter([CASE WHEN p_size <= 10 THEN 'vegan' END, CASE WHEN p_size % 3 = 0 THEN 'gluten free' END,
           CASE WHEN p_size % 4 = 0 THEN 'dairy free' END], lambda d: d IS NOT NULL), ', ') AS diets
  FROM part)
"""

DISTRIBUTION = f"""
labels_ AS (SELECT sentiment_label AS l, count(*) AS n, {_pct('count(*)', '(SELECT count(*) FROM scored)')} AS pct
            FROM scored GROUP BY 1),
mean_ AS (SELECT {_r('avg(compound_score)', 4)} AS m FROM scored)
"""

DISTRIBUTION_ROWS = """
SELECT 'sentiment_distribution' AS aggregation, 'sentiment' AS category, 'sentiment_label' AS dimension_name,
       l AS dimension_value, 'count' AS metric, n::DOUBLE AS value, pct || '% of articles' AS label FROM labels_
UNION ALL SELECT 'sentiment_distribution', 'sentiment', 'sentiment_label', l, 'percentage', pct, n || ' articles' FROM labels_
UNION ALL SELECT 'sentiment_distribution', 'sentiment', 'overall', 'all', 'avg_compound_score', m, 'mean score' FROM mean_
"""

WEEKS = "weeks AS (SELECT date_trunc('week', ts) AS week, avg(compound_score) AS mean, count(*) AS n FROM dated GROUP BY 1)"

TREND_ROWS = f"""
SELECT 'sentiment_trend' AS aggregation, 'temporal' AS category, 'week' AS dimension_name,
       strftime(week, '%Y-%m-%d') || ' 00:00:00' AS dimension_value, 'avg_sentiment' AS metric, {_r('mean', 4)} AS value,
       n || ' articles' AS label FROM weeks
UNION ALL SELECT 'sentiment_trend', 'temporal', 'week', strftime(week, '%Y-%m-%d') || ' 00:00:00', 'article_count',
       n::DOUBLE, strftime(week, '%Y-%m-%d') || ' 00:00:00' FROM weeks
"""


def _volume_rows(source: str) -> str:
    return f"""
SELECT 'volume_trends' AS aggregation, 'temporal' AS category, 'date' AS dimension_name,
       strftime(ts, '%Y-%m-%d') AS dimension_value, 'article_count' AS metric, count(*)::DOUBLE AS value,
       strftime(ts, '%Y-%m-%d') AS label FROM {source} GROUP BY 4
"""


CATEGORIES = """
cats AS (SELECT trim(unnest(string_split(categories, ','))) AS cat, compound_score, sentiment_label FROM scored),
cat_ AS (SELECT cat, count(*) AS n, avg(compound_score) AS mean, count(*) FILTER (sentiment_label = 'positive') AS pos,
                count(*) FILTER (sentiment_label = 'negative') AS neg FROM cats WHERE cat <> '' GROUP BY 1)
"""

CATEGORY_ROWS = f"""
SELECT 'category_breakdown' AS aggregation, 'content' AS category, 'category' AS dimension_name, cat AS dimension_value,
       'article_count' AS metric, n::DOUBLE AS value, cat AS label FROM cat_
UNION ALL SELECT 'category_breakdown', 'content', 'category', cat, 'avg_sentiment', {_r('mean', 4)},
       CASE WHEN mean >= 0.05 THEN 'positive' ELSE 'neutral/negative' END FROM cat_
UNION ALL SELECT 'category_breakdown', 'content', 'category', cat, 'positive_count', pos::DOUBLE, cat FROM cat_
UNION ALL SELECT 'category_breakdown', 'content', 'category', cat, 'negative_count', neg::DOUBLE, cat FROM cat_
"""

_FLAGS = ["vegetarian", "vegan", "glutenFree", "dairyFree", "veryHealthy"]
_NAMES = {"vegetarian": "Vegetarian", "vegan": "Vegan", "glutenFree": "Gluten-free", "dairyFree": "Dairy-free", "veryHealthy": "Very healthy"}

FLAGS = "flags AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, '{_NAMES[f]}' AS name, count(*) FILTER ({f}) AS n, {_pct(f'count(*) FILTER ({f})', 'count(*)')} AS pct FROM recipes" for f in _FLAGS
) + ")"

FLAG_ROWS = """
SELECT 'dietary_breakdown' AS aggregation, 'recommendation' AS category, 'dietary_flag' AS dimension_name,
       flag AS dimension_value, 'count' AS metric, n::DOUBLE AS value, name || ': ' || pct || '% of recipes' AS label FROM flags
UNION ALL SELECT 'dietary_breakdown', 'recommendation', 'dietary_flag', flag, 'percentage', pct, name FROM flags
"""

_CMP = "'source_comparison' AS aggregation, 'cross_source' AS category, 'source' AS dimension_name"
COMPARISON_ROWS = f"""
SELECT {_CMP}, 'web_articles' AS dimension_value, 'avg_sentiment' AS metric, {_r('avg(compound_score)', 4)} AS value,
       count(*) || ' web articles' AS label FROM scored
UNION ALL SELECT {_CMP}, 'web_articles', 'record_count', count(*)::DOUBLE, 'web articles' FROM scored
UNION ALL SELECT {_CMP}, 'api_recipes', 'avg_spoonacular_score', {_r('avg(spoonacularScore)', 4)}, count(*) || ' recipes' FROM recipes
UNION ALL SELECT {_CMP}, 'api_recipes', 'avg_health_score', {_r('avg(healthScore)', 4)}, count(*) || ' recipes' FROM recipes
UNION ALL SELECT {_CMP}, 'api_recipes', 'record_count', count(*)::DOUBLE, 'recipes' FROM recipes
"""


def _top_terms(n: int, where: str = "true") -> str:
    return f"""
best AS (SELECT row_number() OVER (ORDER BY score DESC, term) AS rank, term, score FROM
         (SELECT term, score FROM scores WHERE {where} ORDER BY score DESC, term LIMIT {n}))
"""


KEYWORD_ROWS = f"""
SELECT 'top_keywords' AS aggregation, 'content' AS category, 'rank' AS dimension_name, rank::VARCHAR AS dimension_value,
       'tfidf_score' AS metric, {_r('score / max(score) OVER () * 100', 1)} AS value, term AS label FROM best
"""


def _keyword_sentiment(condition: str, source: str = "best") -> str:
    return f"""
means AS (SELECT term, avg(compound_score) AS mean FROM {source} JOIN scored ON {condition} GROUP BY 1)
"""


KEYWORD_SENTIMENT_ROWS = f"""
SELECT 'keyword_sentiment' AS aggregation, 'sentiment' AS category, 'keyword' AS dimension_name, term AS dimension_value,
       'avg_sentiment' AS metric, {_r('mean', 4)} AS value, {_label('mean')} AS label FROM means
"""


def _bigrams(toks: str, source: str) -> str:
    return f"""
pairs AS (SELECT unnest(list_transform(range(1, len({toks})), lambda i: {toks}[i] || ' ' || {toks}[i + 1])) AS term FROM {source}),
bigrams AS (SELECT term, count(*) AS n FROM pairs WHERE length(term) > 5 GROUP BY 1)
"""


BIGRAM_ROWS = """
SELECT 'top_bigrams' AS aggregation, 'content' AS category, 'rank' AS dimension_name,
       (row_number() OVER (ORDER BY n DESC, term))::VARCHAR AS dimension_value, 'frequency' AS metric, n::DOUBLE AS value,
       term AS label FROM (SELECT * FROM bigrams ORDER BY n DESC, term LIMIT 15)
"""


def _mentions(text: str, source: str) -> str:
    gaz = ", ".join(f"('{n}', '{t}')" for n, t in q.GAZETTEER)
    size = max(len(n.split()) for n, _ in q.GAZETTEER)
    grams = " UNION ALL ".join(
        f"SELECT array_to_string(g[i:i + {k - 1}], ' ') AS phrase FROM (SELECT g, unnest(range(1, len(g) + 2 - {k})) AS i FROM grams)"
        for k in range(1, size + 1)
    )
    return f"""
gaz(name, entity_type) AS (VALUES {gaz}),
grams AS (SELECT string_split({_normal(text)}, ' ') AS g FROM {source}),
phrases AS ({grams}),
mentions AS (SELECT entity_type, name, count(*) AS mentions FROM phrases JOIN gaz ON phrase = name WHERE length(name) >= 3 GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY mentions DESC, name) AS rank FROM mentions)
"""


def _entity_rows(n: int) -> str:
    return f"""
SELECT 'named_entities' AS aggregation, 'entities' AS category, 'entity_type' AS dimension_name,
       entity_type AS dimension_value, 'count' AS metric, mentions::DOUBLE AS value, name AS label FROM placed WHERE rank <= {n}
"""


BUZZ = rf"""
source_ AS (SELECT * FROM scored WHERE compound_score >= 0.05 OR NOT EXISTS (SELECT 1 FROM scored WHERE compound_score >= 0.05)),
buzz AS (SELECT row_number() OVER (ORDER BY n DESC, term) AS rank, term, n FROM (
  SELECT term, count(*) AS n FROM (SELECT unnest(toks) AS term FROM source_) WHERE length(term) > 3
  AND NOT regexp_full_match(term, '{DIGITS}') GROUP BY 1 ORDER BY n DESC, term LIMIT 20))
"""

SEARCH_WORDS = "buzz(rank, term) AS (VALUES " + ", ".join(f"({i + 1}, '{w}')" for i, w in enumerate(q.SEARCH_WORDS)) + ")"


PIECES = """
pieces(rank, term) AS (SELECT length(term), term FROM (
  SELECT substr(p_name, (1 + p_partkey % 7)::INT, (1 + p_partkey % 6)::INT) AS term FROM part UNION SELECT p_partkey::VARCHAR FROM part) WHERE term <> '')
"""
LOWER_BODY = "lower(title || ' ' || cuisines)"


def _alignment(source: str) -> str:
    return f"""
texts AS (SELECT *, lower(coalesce(title, '') || ' ' || coalesce(cuisines, '') || ' ' || coalesce(dishTypes, '')) AS body FROM {source}),
matched AS (SELECT t.id, list(term ORDER BY rank) FILTER (contains(body, term)) AS m FROM texts t, buzz GROUP BY 1),
aligned AS (SELECT t.*, coalesce(len(m), 0) AS hits, array_to_string(m[1:5], '|') AS shown FROM texts t JOIN matched USING (id))
"""


_ALIGN = "'recipe_trend_alignment' AS aggregation, 'recommendation' AS category, 'recipe_id' AS dimension_name, id::VARCHAR AS dimension_value"
ALIGNMENT_ROWS = f"""
SELECT {_ALIGN}, 'trend_score' AS metric, hits::DOUBLE AS value, title AS label FROM aligned
UNION ALL SELECT {_ALIGN}, 'spoonacular_score', coalesce(spoonacularScore, 0)::DOUBLE, title FROM aligned
UNION ALL SELECT {_ALIGN}, 'aggregate_likes', coalesce(aggregateLikes, 0)::DOUBLE, title FROM aligned
UNION ALL SELECT {_ALIGN}, 'matched_keywords', hits::DOUBLE, shown FROM aligned WHERE hits > 0
"""


def _null_rates(table: str, columns: dict[str, bool], source: str) -> str:
    """columns: name -> is text."""
    parts = []
    for c, text in columns.items():
        missing = f"{c} IS NULL" + (f" OR trim({c}) = ''" if text else "")
        parts.append(
            f"SELECT 'null_rate' AS kpi_name, 'completeness' AS category, '{source}' AS source, '{c}' AS field, "
            f"{_pct(f'count(*) FILTER ({missing})', 'count(*)')} AS value, '%' AS unit, "
            f"count(*) FILTER ({missing}) || ' of ' || count(*) || ' rows lack a value' AS finding FROM {table}"
        )
    return " UNION ALL ".join(parts)


def _duplicates(table: str, key: str, source: str) -> str:
    d = f"count(*) - (count(DISTINCT {key}) + max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END))"
    return (
        f"SELECT 'duplicate_rate' AS kpi_name, 'uniqueness' AS category, '{source}' AS source, '{key}' AS field, "
        f"{_pct(d, 'count(*)')} AS value, '%' AS unit, "
        f"({d})::BIGINT || ' of ' || count(*) || ' rows repeat a value of {key}' AS finding FROM {table}"
    )


def _records(table: str, source: str) -> str:
    return (
        f"SELECT 'record_count' AS kpi_name, 'volume' AS category, '{source}' AS source, NULL::VARCHAR AS field, "
        f"count(*)::DOUBLE AS value, 'records' AS unit, "
        f"count(*) || ' rows from {source}' AS finding FROM {table}"
    )


def _fence_note(c: str, out: str) -> str:
    q1, q3 = "any_value(q1)", "any_value(q3)"
    shown = f"{q1} - 1.5 * ({q3} - {q1}), {q3} + 1.5 * ({q3} - {q1}), {q1}, {q3}"
    return (
        f"CASE WHEN {q3} = {q1} THEN printf('quartiles of %d values coincide, so no fence', count({c})) "
        f"ELSE printf('%d of %d rows lie beyond %.2f to %.2f (quartiles %.2f and %.2f)', count(*) FILTER ({out}), count(*), {shown}) END"
    )


def _outliers(table: str, columns, source: str, quantile: str = "quantile_disc") -> str:
    parts = []
    for c in columns:
        fence = f"(SELECT {quantile}({c}, 0.25)::DOUBLE AS q1, {quantile}({c}, 0.75)::DOUBLE AS q3 FROM {table})"
        out = f"{c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)"
        value = f"CASE WHEN any_value(q3) = any_value(q1) THEN 0 ELSE {_pct(f'count(*) FILTER ({out})', 'count(*)')} END"
        parts.append(
            f"SELECT 'outlier_rate' AS kpi_name, 'validity' AS category, '{source}' AS source, '{c}' AS field, "
            f"({value})::DOUBLE AS value, '%' AS unit, {_fence_note(c, out)} AS finding FROM {table}, {fence} HAVING count({c}) >= 4"
        )
    return " UNION ALL ".join(parts)


def _compliance(source: str, present: int, expected: int, missing, extra) -> str:
    def shown(names) -> str:
        return ", ".join(sorted(names))

    note = f"{present} of {expected} columns found" + (f", not {shown(missing)}" if missing else "")
    sql = (
        f"SELECT 'schema_compliance_rate' AS kpi_name, 'validity' AS category, '{source}' AS source, NULL::VARCHAR AS field, "
        f"{_r(f'{present}::DOUBLE / {expected} * 100', 2)} AS value, '%' AS unit, '{note}' AS finding"
    )
    if extra:
        sql += (
            f" UNION ALL SELECT 'unexpected_columns', 'validity', '{source}', NULL, {len(extra)}::DOUBLE, 'columns', "
            f"'columns nobody asked for: {shown(extra)}'"
        )
    return sql


_RECIPE_TYPES = {
    "id": False, "title": True, "cuisines": True, "dishTypes": True, "spoonacularScore": False, "healthScore": False,
    "aggregateLikes": False, "readyInMinutes": False, "vegetarian": False, "vegan": False, "glutenFree": False,
    "dairyFree": False, "veryHealthy": False, "ingredient_names": True, "diets": True,
}
_WEB_TYPES = {
    "article_id": False, "article_title": True, "article_summary": True, "categories": True, "source": True, "author": True,
    "quality": False, "toxic": False,
}
_K = "kpi_name, category, source, field, value, unit, finding"
_WEB_TYPES |= {"article_summary_clean": True, "article_title_clean": True}
_RECIPE_TYPES |= {"summary": True}
_FILE_ROWS = """
SELECT 'source_file_count' AS kpi_name, 'volume' AS category, source, NULL::VARCHAR AS field, arg_max(n, dt)::DOUBLE AS value, 'files' AS unit,
       arg_max(n, dt) || ' files of ' || source || ' on ' || max(dt)::VARCHAR AS finding
FROM (SELECT o_orderstatus AS source, o_orderdate::DATE AS dt, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY source"""
_INGESTION = (
    "WITH d AS (SELECT event_type AS source, count(DISTINCT ts::DATE) AS days, count(*) AS n, string_agg(DISTINCT ts::DATE::VARCHAR, ', ' ORDER BY ts::DATE::VARCHAR) AS names FROM events GROUP BY 1) "
    "SELECT 'ingestion_distinct_dates' AS kpi_name, 'timeliness' AS category, source, NULL::VARCHAR AS field, days::DOUBLE AS value, 'dates' AS unit, source || ' landed on ' || days || ' days: ' || names AS finding FROM d "
    "UNION ALL SELECT 'ingestion_file_count', 'timeliness', source, NULL, n::DOUBLE, 'files', n || ' landed files of ' || source FROM d"
)
_COVERAGE = (
    "WITH targets(name) AS (VALUES " + ", ".join(f"('{n}')" for n in q.TARGETS) + "), "
    "hit AS (SELECT count(*) FILTER (name IN (SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey)) AS f, count(*) AS n FROM targets) "
    f"SELECT 'ingredient_coverage' AS kpi_name, 'volume' AS category, 'api' AS source, NULL::VARCHAR AS field, {_pct('f', 'n')} AS value, '%' AS unit, "
    "'data landed for ' || f || ' of ' || n || ' targets' AS finding FROM hit"
)


def _compression() -> str:
    mean = "avg(length(clean)::DOUBLE / length(article_summary))"
    return (
        f"SELECT 'nlp_compression_ratio' AS kpi_name, 'accuracy' AS category, 'webscraping' AS source, 'article_summary_clean' AS field, {_r(mean, 4)} AS value, "
        f"'ratio' AS unit, printf('cleaning keeps %.2f%% of a text on average', {mean} * 100) AS finding FROM articles WHERE article_summary <> '' AND clean <> ''"
    )


def _columns_seen(source: str, expected, types) -> str:
    expected, types = set(expected), set(types)
    return _compliance(source, len(expected & types), len(expected), expected - types, types - expected)


def _text_stats(table: str, c: str, source: str, digits: int | None = 3) -> str:
    def shown(x: str) -> str:
        return _r(x, digits) if digits else f"({x})::DOUBLE"

    stats = {"mean": f"avg(length({c}))", "median": f"quantile_disc(length({c}), 0.5)", "min": f"min(length({c}))", "max": f"max(length({c}))"}
    rows = [
        f"SELECT 'text_length_{k}' AS kpi_name, 'accuracy' AS category, '{source}' AS source, '{c}' AS field, {shown(v)} AS value, "
        f"'chars' AS unit, '{k} number of characters of {c}' AS finding FROM {table} WHERE {c} <> ''"
        for k, v in stats.items()
    ]
    foreign = rf"sum(length({c}) - length(regexp_replace({c}, '[^\x00-\x7F]', '', 'g')))"
    rows.append(
        f"SELECT 'non_ascii_ratio', 'accuracy', '{source}', '{c}', {_pct(foreign, f'sum(length({c}))', 3)}, '%', "
        f"{foreign}::BIGINT || ' of ' || sum(length({c}))::BIGINT || ' characters are not ASCII; English text should stay below 1%' "
        f"FROM {table} WHERE {c} <> ''"
    )
    return " UNION ALL ".join(rows)


def _governance() -> str:
    numbers = [c for c in RECIPE_NUMERIC_COLUMNS if c in _RECIPE_TYPES]
    parts = [
        _null_rates("web", _WEB_TYPES, "webscraping"), _records("web", "webscraping"), _duplicates("web", "article_id", "webscraping"),
        _columns_seen("webscraping", EXPECTED_ARTICLE_COLUMNS, _WEB_TYPES), _text_stats("web", "article_summary", "webscraping", None),
        _text_stats("web", "article_summary_clean", "webscraping", None), _compression(),
        _null_rates("dishes", _RECIPE_TYPES, "api"), _records("dishes", "api"), _duplicates("dishes", "id", "api"),
        _columns_seen("api", EXPECTED_RECIPE_COLUMNS, _RECIPE_TYPES), _text_stats("dishes", "summary", "api", None), _outliers("dishes", numbers, "api"),
        _FILE_ROWS, _INGESTION, _COVERAGE,
    ]
    return ARTICLES + "," + RECIPES + f""",
web AS (SELECT r.* EXCLUDE (toks, title_toks, clean, title_clean), r.clean AS article_summary_clean, r.title_clean AS article_title_clean, l.quality, l.toxic
        FROM articles r LEFT JOIN labels l ON l.doc_id = r.article_id),
dishes AS (SELECT *, title || ' – ' || cuisines AS summary FROM recipes),
facts AS ({" UNION ALL ".join(f"SELECT {_K} FROM ({part})" for part in parts)})
"""


GOVERNANCE = _governance()

_WHOLE = """length('{"results":[{"id":' || doc_id || ',"title":"' || source || '","image":"' || lang || '"}]}') // 2"""
_REJECTS = f"""
SELECT 'api' AS source, 'p' || doc_id AS source_file, CASE WHEN doc_id % 7 = 0 THEN 'unreadable' WHEN doc_id % 11 = 0 THEN 'incomplete' ELSE 'unreadable' END AS reason,
       CASE WHEN doc_id % 7 = 0 THEN {_WHOLE} WHEN doc_id % 11 = 0 THEN NULL ELSE 17 END AS chars
FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 13 = 0"""

S = "aggregation, category, dimension_name, dimension_value, metric, value, label"
STORY = (
    SCORED + "," + RECIPES + "," + DISTRIBUTION + "," + WEEKS + "," + CATEGORIES + "," + FLAGS + "," + _tfidf() + ","
    + _top_terms(20, f"term IN {_list(q.VOCABULARY)}") + ", best15 AS (SELECT * FROM best WHERE rank <= 15), "
    + _keyword_sentiment("contains(clean, term)", "best15") + "," + _bigrams("toks", "articles") + ","
    + _mentions("article_title", "raw") + "," + BUZZ + "," + _alignment("recipes") + f""",
facts AS (
  SELECT {S} FROM ({DISTRIBUTION_ROWS}) UNION ALL SELECT {S} FROM ({TREND_ROWS})
  UNION ALL SELECT {S} FROM ({KEYWORD_ROWS}) UNION ALL SELECT {S} FROM ({BIGRAM_ROWS})
  UNION ALL SELECT {S} FROM ({KEYWORD_SENTIMENT_ROWS}) UNION ALL SELECT {S} FROM ({COMPARISON_ROWS})
  UNION ALL SELECT {S} FROM ({_volume_rows('dated')}) UNION ALL SELECT {S} FROM ({CATEGORY_ROWS})
  UNION ALL SELECT {S} FROM ({ALIGNMENT_ROWS}) UNION ALL SELECT {S} FROM ({FLAG_ROWS})
  UNION ALL SELECT {S} FROM ({_entity_rows(8)}))
"""
)


def _search(source: str, body: str, terms: str, score: str, number: int, order: str = "id") -> str:
    return f"""
found AS (SELECT lower(term) AS query, id, {score} AS score FROM {source}, {terms} WHERE contains({body}, lower(term))),
placed AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY score DESC NULLS LAST, {order}) AS rank FROM found)
SELECT query, rank, p.id FROM placed p WHERE rank <= {number}
"""


def _ingredients(where: str = "true") -> str:
    wanted = ", ".join(f"('{i}')" for i in q.INGREDIENTS)
    return f"""
WITH {RECIPES}, wanted(query) AS (VALUES {wanted}),
found AS (SELECT query, id, spoonacularScore AS score FROM recipes, wanted
          WHERE list_contains(string_split(ingredient_names, ', '), query) AND {where}),
placed AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM found)
SELECT query, rank, id FROM placed WHERE rank <= 10
"""


_OUT4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _report(table: str, columns) -> str:
    parts = []
    for c in columns:
        fence = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})"
        out = f"q3 <> q1 AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))"
        parts.append(
            f"SELECT '{c}' AS field, {_pct(f'count(*) FILTER ({out})', f'count({c})')} AS outlier_rate, {_r(f'avg({c})', 2)} AS mean, "
            f"{_r(f'stddev_samp({c})', 2)} AS std, {_r(f'min({c})', 2)} AS min, {_r(f'max({c})', 2)} AS max FROM {table}, {fence}"
        )
    return " UNION ALL ".join(parts)


def _describe(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, count({c}) AS count, {_r(f'avg({c})', 2)} AS mean, {_r(f'stddev_samp({c})', 2)} AS std, "
        f"{_r(f'min({c})', 2)} AS min, {_r(f'quantile_cont({c}, 0.25)', 2)} AS q25, {_r(f'quantile_cont({c}, 0.5)', 2)} AS q50, "
        f"{_r(f'quantile_cont({c}, 0.75)', 2)} AS q75, {_r(f'max({c})', 2)} AS max FROM {table}"
        for c in columns
    )


def _length_describe(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, count({c}) AS count, {_r(f'avg(length({c}))', 1)} AS mean, "
        f"{_r(f'quantile_cont(length({c}), 0.5)', 1)} AS median, min(length({c})) AS min, max(length({c})) AS max, "
        f"{_r(f'stddev_samp(length({c}))', 1)} AS std FROM {table}"
        for c in columns
    )


def _visible(x: str) -> str:
    for tag in ("script", "style", "template"):
        x = rf"regexp_replace({x}, '(?is)<{tag}\b.*?</{tag}\s*>', chr(1), 'g')"
    x = rf"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"
    x = rf"regexp_replace({x}, '(?s)</?[a-zA-Z][^>]*>|<[!?][^>]*>', chr(1), 'g')"
    node = r"regexp_replace({}, '^[\s\x{{85}}\x{{A0}}]+|[\s\x{{85}}\x{{A0}}]+$', '', 'g')".format(_decoded("w"))
    return f"array_to_string(list_filter(list_transform(string_split({x}, chr(1)), lambda w: {node}), lambda w: w <> ''), ' ')"


def _decoded(x: str) -> str:
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", " "), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def _batches(source: str, keys: str) -> str:
    return f"SELECT day, batch, list_sort(list(DISTINCT id)) AS ids FROM {source} GROUP BY day, batch"


_NAN_PRICES = "(SELECT CASE WHEN l_linenumber < 6 THEN l_extendedprice END AS price, l_quantity FROM lineitem)"

ORACLE: dict[str, str] = {
    # cleaning
    "clean_text": f"SELECT doc_id, array_to_string({_tokens('text')}, ' ') AS clean FROM documents",
    "clean_articles": f"WITH {ARTICLES} SELECT article_id, article_title, title_clean AS article_title_clean, clean AS article_summary_clean FROM articles",
    "unescape_title": f"SELECT page_id, {_decoded('''regexp_extract(html, '<title>(.*?)</title>', 1)''')} AS title FROM pages",
    "strip_html": f"SELECT page_id, {_visible(_decoded('html'))} AS visible FROM pages",
    "strip_tags_simple": r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<.*?>', '', 'g'), '[\s\x{85}\x{A0}\p{Z}]+', ' ', 'g')) AS plain FROM pages",
    "photo_attribution": f"SELECT doc_id, {_no_credit('text')} AS body FROM documents",
    "list_to_csv": "SELECT conv_id, string_agg(turn::VARCHAR, ', ' ORDER BY turn) AS turns FROM conversations GROUP BY 1",
    "ingredient_names": "SELECT l_orderkey, coalesce(string_agg(p_name, ', ' ORDER BY l_linenumber, p_partkey, p_name) FILTER (l_quantity > 5 AND p_name <> ''), '') AS names FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "instruction_text": r"SELECT conv_id, coalesce(string_agg(trim(text), ' ' ORDER BY turn, text) FILTER (role <> 'system' AND text <> ''), '') AS instructions FROM conversations GROUP BY 1",
    "number_coercion": "SELECT doc_id, try_cast(substr(source, 4, 9) AS INTEGER) AS number, try_cast(lang AS INTEGER) AS none FROM documents",
    "flag_tags": f"WITH {RECIPES} SELECT id, array_to_string(list_filter([CASE WHEN vegetarian THEN 'vegetarian' END, CASE WHEN vegan THEN 'vegan' END, CASE WHEN glutenFree THEN 'gluten_free' END, CASE WHEN dairyFree THEN 'dairy_free' END], lambda x: x IS NOT NULL), '|') AS tags FROM recipes",
    "default_text": "SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'Untitled' END AS note FROM documents d LEFT JOIN labels l USING (doc_id)",
    "published_dates": "SELECT doc_id AS article_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS published_at FROM documents LEFT JOIN events ON event_id = doc_id",
    "safe_names": "SELECT c_custkey, trim(regexp_replace(lower(c_name || ' ' || c_mktsegment), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM customer",
    "search_names": "SELECT p_partkey, replace(p_name, ' ', '_') || '_diet_' || p_type || CASE WHEN p_size > 25 THEN '_intol_aANDb' ELSE '' END AS name FROM part",
    "filled_text": "SELECT d.doc_id, CASE WHEN toxic = 0 THEN 'clean' ELSE '' END AS state, quality FROM documents d LEFT JOIN labels l USING (doc_id)",
    # quality
    "null_rate": "WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) "
    + _null_rates("j", {"doc_id": False, "text": True, "lang": True, "source": True, "n_chars": False, "quality": False, "toxic": False}, "webscraping"),
    "null_overview": f"WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) SELECT 'web' AS source, count(*) AS records, 7 AS columns, CASE WHEN count(*) > count(quality) THEN 2 ELSE 0 END AS fields_with_nulls, {_r('(count(*) - count(quality)) / count(*) * 100', 1)} AS max_null_rate, 'quality' AS worst_field FROM j",
    "record_count": _records("lineitem", "api"),
    "duplicate_rate_key": _duplicates("lineitem", "l_partkey", "api"),
    "duplicate_rate_text": _duplicates("documents", "text", "webscraping"),
    "full_row_duplicates": f"SELECT sum(n)::BIGINT AS total, sum(n - 1)::BIGINT AS duplicates, {_pct('sum(n - 1)', 'sum(n)')} AS rate FROM (SELECT count(*) AS n FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE lang <> 'en') GROUP BY doc_id, text, lang, source, n_chars)",
    "dedupe_keep_first": "SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1",
    "curated_articles": f"WITH {ARTICLES} SELECT article_id, article_title, categories, source, author FROM articles",
    "outlier_rate_disc": _outliers("lineitem", _OUT4, "api"),
    "outlier_rate_exact": _report("lineitem", _OUT4),
    "outlier_rate_balance": _report("customer", ["c_acctbal"]),
    "text_length_stats": _text_stats("documents", "text", "webscraping"),
    "text_length_describe": _length_describe("pages", ["url", "html"]),
    "compression_ratio": f"WITH {ARTICLES} SELECT 'nlp_compression_ratio' AS kpi_name, 'accuracy' AS category, 'webscraping' AS source, 'article_summary_clean' AS field, {_r('avg(length(clean)::DOUBLE / length(article_summary))', 4)} AS value, 'ratio' AS unit, printf('cleaning keeps %.2f%% of a text on average', avg(length(clean)::DOUBLE / length(article_summary)) * 100) AS finding FROM articles WHERE article_summary <> '' AND clean <> ''",
    "describe_with_nan": _describe(_NAN_PRICES, ["price", "l_quantity"]),
    "outlier_report_with_nan": _report(_NAN_PRICES, ["price"]),
    "substring_terms": f"WITH {PIECES} SELECT term, count(*) AS documents, sum(length(text)) AS chars FROM documents JOIN pieces ON contains(text, term) GROUP BY 1",
    "keyword_sentiment_long_list": f"WITH {SCORED}, {PIECES} SELECT term, count(*) AS documents, round(sum(compound_score) * 10000)::BIGINT AS total FROM pieces JOIN scored ON contains(clean, term) GROUP BY 1",
    "alignment_long_list": f"WITH {RECIPES}, {PIECES}, bodies AS (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(cuisines, '') || ' ' || coalesce(dishTypes, '')) AS body FROM recipes), "
    "found AS (SELECT id, list(term ORDER BY rank, term) AS m FROM bodies JOIN pieces ON contains(body, term) WHERE rank > 2 GROUP BY 1) "
    "SELECT id, coalesce(len(m), 0) AS hits, coalesce(array_to_string(m, '|'), '') AS found FROM bodies LEFT JOIN found USING (id)",
    "keyword_search_long_list": f"WITH {RECIPES}, {PIECES}, buzz(rank, term) AS (SELECT DISTINCT 1, lower(term) FROM pieces), {_search('recipes', LOWER_BODY, 'buzz', 'spoonacularScore', 3)}",
    "keyword_search_mixed_case": f"WITH {RECIPES}, {SEARCH_WORDS}, {_search('recipes', '''lower(title || ' ' || cuisines)''', 'buzz', 'spoonacularScore', 5)}",
    "outlier_rate_sketch": "SELECT kind, field, p, (SELECT count(*) FROM lineitem) AS n, true AS inside FROM (VALUES ('whole'), ('daily')) k(kind), (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) f(field), (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) p(p)",
    "outlier_rate_approximate": f"SELECT kpi_name, source, field, value FROM ({_outliers('lineitem', ['l_quantity', 'l_discount', 'l_tax'], 'api')})",
    "describe_numeric": _describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]),
    "exact_medians": " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS p, round(quantile_cont(o_totalprice, {p}), 4) AS cont, quantile_disc(o_totalprice, {p}) AS disc FROM orders" for p in (0.1, 0.5, 0.9)
    ),
    "schema_compliance": _compliance("webscraping", 4, 6, ["title", "author"], ["n_chars"]),
    "target_coverage": "WITH targets(name) AS (VALUES " + ", ".join(f"('{n}')" for n in q.TARGETS) + "), "
    f"hit AS (SELECT t.name, EXISTS (SELECT 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = t.name) AS f FROM targets t) "
    f"SELECT 'ingredient_coverage' AS kpi_name, 'volume' AS category, 'api' AS source, NULL::VARCHAR AS field, {_pct('count(*) FILTER (f)', 'count(*)')} AS value, '%' AS unit, 'data landed for ' || count(*) FILTER (f) || ' of ' || count(*) || ' targets' AS finding FROM hit",
    # sentiment and trends
    "sentiment_large_lexicon": f"WITH {SCORED_LARGE} SELECT article_id, compound_score, sentiment_label FROM scored",
    "sentiment_score": f"WITH {SCORED} SELECT article_id, compound_score, sentiment_label FROM scored",
    "sentiment_distribution": f"WITH {SCORED}, {DISTRIBUTION} {DISTRIBUTION_ROWS}",
    "sentiment_trend_weekly": f"WITH {SCORED}, {WEEKS} {TREND_ROWS}",
    "weekly_windows_batch": f"SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, {_r('avg(value)', 4)} AS avg_sentiment, count(*) AS article_count FROM events GROUP BY 1",
    "volume_daily": _volume_rows("events"),
    "category_breakdown": f"WITH {SCORED}, {CATEGORIES} {CATEGORY_ROWS}",
    "flag_breakdown": f"WITH {RECIPES}, {FLAGS} {FLAG_ROWS}",
    "source_comparison": f"WITH {SCORED}, {RECIPES} {COMPARISON_ROWS}",
    "buzz_words": f"WITH {SCORED}, {BUZZ} SELECT rank, term, n FROM buzz",
    "trend_alignment": f"WITH {RECIPES}, {SEARCH_WORDS}, {_alignment('recipes')} {ALIGNMENT_ROWS}",
    "trend_alignment_articles": f"WITH {SCORED}, {BUZZ}, turns AS (SELECT conv_id || '-' || turn AS id, text AS title, role AS cuisines, NULL::VARCHAR AS dishTypes FROM conversations), {_alignment('turns')} "
    "SELECT id AS dimension_value, 'trend_score' AS metric, hits::DOUBLE AS value, NULL::VARCHAR AS label FROM aligned UNION ALL SELECT id, 'matched_keywords', hits::DOUBLE, shown FROM aligned WHERE hits > 0",
    # vocabulary
    "tfidf_scores": f"WITH {ARTICLES}, {_tfidf()} SELECT term, total, {_r('score', 6)} AS score FROM scores",
    "tfidf_top_keywords": f"WITH {ARTICLES}, {_tfidf()}, {_top_terms(20)} {KEYWORD_ROWS}",
    "tfidf_topic_keywords": f"WITH {ARTICLES}, " + _tfidf("(clean || ' ' || title_clean)") + f", {_top_terms(10, f'term IN {_list(q.VOCABULARY)}')} SELECT rank, term, {_r('score', 6)} AS score FROM best",
    "frequency_keywords": f"WITH {ARTICLES} SELECT row_number() OVER (ORDER BY n DESC, term) AS rank, term, n::DOUBLE AS score FROM (SELECT term, count(*) AS n FROM (SELECT unnest(list_concat(toks, title_toks)) AS term FROM articles) WHERE term IN ('that', 'absent') GROUP BY 1)",
    "top_bigrams": f"WITH {ARTICLES}, {_bigrams('toks', 'articles')} {BIGRAM_ROWS}",
    "conversation_bigrams": f"WITH c AS (SELECT {_tokens('text', ())} AS toks FROM conversations), {_bigrams('toks', 'c')} SELECT row_number() OVER (ORDER BY n DESC, term) AS rank, term, n FROM (SELECT * FROM bigrams ORDER BY n DESC, term LIMIT 50)",
    "keyword_sentiment": f"WITH {SCORED}, {_tfidf()}, {_top_terms(15)}, {_keyword_sentiment('contains(clean, term)')} {KEYWORD_SENTIMENT_ROWS}",
    "keyword_sentiment_words": f"WITH {SCORED}, {_tfidf()}, {_top_terms(15)}, {_keyword_sentiment('list_contains(toks, term)')} {KEYWORD_SENTIMENT_ROWS}",
    "entity_counts": f"WITH {_mentions('text', 'documents')} SELECT entity_type, name, mentions FROM mentions",
    "entity_top_titles": f"WITH {ARTICLES}, {_mentions('article_title', 'raw')} {_entity_rows(2)}",
    "entity_top_combined": f"WITH {ARTICLES}, both_ AS (SELECT article_title || '. ' || article_summary AS b FROM raw), {_mentions('b', 'both_')} SELECT entity_type, rank, name, mentions FROM placed WHERE rank <= 10",
    # search
    "keyword_search_topn": f"WITH {RECIPES}, {SEARCH_WORDS}, {_search('recipes', '''lower(title || ' ' || cuisines)''', 'buzz', 'spoonacularScore', 5).replace('SELECT query, rank, p.id FROM placed p', 'SELECT query, rank, p.id, title FROM placed p JOIN recipes r USING (id)')}",
    "conversation_search": f"WITH {ARTICLES}, {_tfidf()}, {_top_terms(10)}, turns AS (SELECT conv_id || '-' || turn AS id, lower(text) AS body, length(text) AS score_ FROM conversations), {_search('turns', 'body', 'best', 'score_', 5)}",
    "ingredient_search": _ingredients(),
    "ingredient_search_diet": _ingredients("(contains(diets, 'vegan') OR contains(diets, 'dairy free')) AND contains(diets, 'gluten free')"),
    "missing_keys": "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)",
    "recipe_filter_rank": f"WITH {RECIPES}, f AS (SELECT * FROM recipes WHERE contains(lower(cuisines), 'conom') AND vegetarian AND readyInMinutes <= 18) SELECT row_number() OVER (ORDER BY spoonacularScore DESC, id) AS rank, (SELECT count(*) FROM f) AS total, id, title, cuisines, readyInMinutes, spoonacularScore FROM f ORDER BY 1 LIMIT 20",
    "recipe_list_all": f"WITH {RECIPES} SELECT row_number() OVER (ORDER BY spoonacularScore DESC, id) AS rank, (SELECT count(*) FROM recipes) AS total, id, title FROM recipes ORDER BY 1 LIMIT 20",
    "point_lookup": f"WITH {RECIPES} SELECT id, title, readyInMinutes, cuisines, dishTypes, diets, vegetarian, vegan, glutenFree, dairyFree, ingredient_names, spoonacularScore, healthScore, aggregateLikes FROM recipes WHERE id = 42",
    # partitions and batches
    "latest_partition": "SELECT event_id, user_id, event_type, value FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)",
    "latest_run": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
    "feed_cap": "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events) WHERE k <= 20",
    "ingestion_inventory": "WITH d AS (SELECT event_type AS source, ts::DATE AS dt, count(*) AS n FROM events GROUP BY 1, 2) SELECT source, count(*) AS distinct_dates, sum(n)::BIGINT AS files, arg_max(n, dt) AS latest_files, max(dt)::VARCHAR AS latest_date FROM d GROUP BY 1",
    "ingestion_frequency": "WITH d AS (SELECT event_type AS source, count(DISTINCT ts::DATE) AS days, count(*) AS n, string_agg(DISTINCT ts::DATE::VARCHAR, ', ' ORDER BY ts::DATE::VARCHAR) AS names FROM events GROUP BY 1) "
    "SELECT 'ingestion_distinct_dates' AS kpi_name, 'timeliness' AS category, source, NULL::VARCHAR AS field, days::DOUBLE AS value, 'dates' AS unit, source || ' landed on ' || days || ' days: ' || names AS finding FROM d "
    "UNION ALL SELECT 'ingestion_file_count', 'timeliness', source, NULL, n::DOUBLE, 'files', n || ' landed files of ' || source FROM d",
    "retention_plan": f"SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS name, CASE WHEN o_orderdate::DATE < DATE '{q.TODAY}' - 30 THEN 'deleted' ELSE 'kept' END AS status FROM orders",
    "batch_set_equality": f"WITH n AS (SELECT year(o_orderdate) AS day, o_custkey AS batch, o_orderpriority AS id FROM orders WHERE o_orderstatus = 'O'), s AS (SELECT year(o_orderdate) AS day, o_custkey AS batch, o_orderpriority AS id FROM orders WHERE o_orderstatus = 'F'), "
    f"a AS ({_batches('n', 'id')}), b AS ({_batches('s', 'id')}) SELECT day, batch FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.day = a.day AND b.ids = a.ids)",
    "batch_skip": f"WITH n AS (SELECT l_returnflag AS day, l_orderkey AS batch, l_linenumber AS id FROM lineitem WHERE l_orderkey % 2 = 0), s AS (SELECT l_returnflag AS day, l_orderkey AS batch, l_linenumber AS id FROM lineitem WHERE l_orderkey % 2 = 1), "
    f"a AS ({_batches('n', 'id')}), b AS ({_batches('s', 'id')}), r AS (SELECT day, batch FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.day = a.day AND b.ids = a.ids)) "
    "SELECT day, count(*) AS n, count(DISTINCT batch) AS batches FROM n ANTI JOIN r USING (day, batch) GROUP BY 1",
    "union_by_name": "SELECT lang, role, count(*) AS n, sum(id)::BIGINT AS ids FROM (SELECT doc_id AS id, lang FROM documents UNION ALL BY NAME SELECT conv_id AS id, role FROM conversations) GROUP BY 1, 2",
    "run_summary": " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows, 1 AS files FROM {n}" for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")),
    # landing
    "recipe_payload_rows": f"WITH {RECIPES} SELECT id, title, cuisines, spoonacularScore, healthScore, readyInMinutes, vegetarian, replace(ingredient_names, ', ', '|') AS ingredients, readyInMinutes || 'd' AS cookingMinutes, NULL::VARCHAR AS license, dishTypes || '-' || readyInMinutes AS _source_file FROM recipes",
    "silver_recipes": f"WITH {RECIPES} SELECT id, title, cuisines, dishTypes, diets, readyInMinutes AS preparationMinutes, NULL::INTEGER AS cookingMinutes, ingredient_names, title || ' Serve.' AS instructions_text, title || ' for & all' AS summary, NULL::VARCHAR AS license FROM recipes",
    "gold_recipes": f"WITH {RECIPES} SELECT id, title, cuisines, vegetarian, ingredient_names, array_to_string(list_filter([CASE WHEN vegetarian THEN 'vegetarian' END, CASE WHEN vegan THEN 'vegan' END, CASE WHEN glutenFree THEN 'gluten_free' END, CASE WHEN dairyFree THEN 'dairy_free' END], lambda x: x IS NOT NULL), '|') AS tags FROM recipes",
    "article_payload_rows": r"SELECT doc_id::VARCHAR AS article_id, regexp_extract(text, '^[^.\n]*') AS article_title, text AS article_summary, source || '|' || lang AS categories, lang AS author, f AS _source_file FROM documents, (SELECT unnest(['a.json', 'b.json']) AS f)",
    "silver_articles": f"WITH {ARTICLES} SELECT article_id::VARCHAR AS article_id, article_title, title_clean AS article_title_clean, clean AS article_summary_clean, author FROM articles",
    "rss_rows": "SELECT p_partkey::VARCHAR AS article_id, CASE WHEN p_size > 3 THEN p_name ELSE 'Untitled' END AS article_title, 'http://x/?a&b=' || p_partkey AS article_url, '' AS author, 'Tue, 26 May 2026 10:11:12 GMT' AS published_date, CASE WHEN p_size > 40 THEN 'Long ' ELSE 'Short ' END || p_name AS article_summary, 'feed' AS source, 'New York City' AS location_focus, p_brand || '|' || p_type AS categories FROM part",
    "atom_rows": "SELECT p_partkey::VARCHAR AS article_id, p_name AS article_title, 'http://x/' || p_partkey AS article_url, p_brand AS author, CASE WHEN p_size > 25 THEN '2026-05-26T10:11:12-04:00' ELSE '2026-05-27' END AS published_date, p_name AS article_summary, 'feed' AS source, 'New York City' AS location_focus, p_type AS categories FROM part",
    # serving
    "rejected_payloads": _REJECTS,
    "accepted_payload_rows": "SELECT doc_id AS id, source AS title, lang, 'p' || doc_id AS file FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0",
    "reject_rate": f"SELECT 'rejected_payloads' AS kpi_name, 'validity' AS category, source, reason AS field, count(*)::DOUBLE AS value, 'payloads' AS unit, count(*) || ' payloads of api are ' || reason AS finding FROM ({_REJECTS}) GROUP BY source, reason",
    "landed_newest_day": "SELECT o_orderstatus AS source, o_orderdate::DATE::VARCHAR AS dt, o_orderkey AS path FROM orders o WHERE o_orderdate::DATE = (SELECT max(o_orderdate::DATE) FROM orders i WHERE i.o_orderstatus = o.o_orderstatus)",
    "publish_round_trip": "SELECT 'orders_' || lower(o_orderstatus) AS \"table\", strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1, 2",
    "streamed_articles": f"WITH {ARTICLES} SELECT article_id, source, length(clean) AS chars FROM articles",
    "governance_job": f"WITH {GOVERNANCE} SELECT * FROM facts",
    "governance_rows": f"WITH {GOVERNANCE} SELECT *, '{q.RUN_TS.date()}' AS partition_date, (SELECT count(*) FROM facts) AS row_count FROM facts",
    "kpi_summary": f"WITH {GOVERNANCE} SELECT (sum(value) FILTER (kpi_name = 'record_count'))::BIGINT AS total_records, max(value) FILTER (kpi_name = 'null_rate') AS max_null_rate, max(value) FILTER (kpi_name = 'duplicate_rate') AS duplicate_rate, min(value) FILTER (kpi_name = 'schema_compliance_rate') AS schema_compliance_rate FROM facts",
    "null_rates_severity": f"WITH {GOVERNANCE} SELECT source, field, value, CASE WHEN value > 50 THEN 'high' WHEN value > 20 THEN 'medium' ELSE 'low' END AS severity FROM facts WHERE kpi_name = 'null_rate' AND value > 0",
    "volume_by_source_day": f"WITH {GOVERNANCE} SELECT source, '{q.RUN_TS.date()}' AS date, sum(value) AS value FROM facts WHERE kpi_name = 'record_count' GROUP BY 1",
    "outliers_over_threshold": f"WITH {GOVERNANCE} SELECT source, field, value, value > 1 AS over_threshold FROM facts WHERE kpi_name = 'outlier_rate'",
    "kpi_table": f"WITH {GOVERNANCE} SELECT kpi_name, category, source, field, {_r('value', 2)} AS value, unit, finding FROM facts",
    "kpi_names_per_category": f"WITH {GOVERNANCE} SELECT category, count(DISTINCT kpi_name) AS kpi_names FROM facts GROUP BY 1",
    "distinct_names": f"WITH {GOVERNANCE} SELECT string_agg(DISTINCT kpi_name, ',' ORDER BY kpi_name) AS kpi_name, string_agg(DISTINCT category, ',' ORDER BY category) AS category FROM facts",
    "storytelling_rows": f"WITH {STORY} SELECT *, (SELECT count(*) FROM facts) AS row_count FROM facts",
    "sentiment_with_percentages": f"WITH {SCORED}, {DISTRIBUTION} SELECT l AS label, n AS count, pct AS percentage, m AS avg_compound_score FROM labels_, mean_",
    "positive_share": f"WITH {SCORED} SELECT floor(count(*) FILTER (sentiment_label = 'positive') / count(*) * 100)::BIGINT AS pct_positive FROM scored",
    "dominant_label": f"WITH {SCORED}, {DISTRIBUTION} SELECT l AS label, n::DOUBLE AS value FROM labels_ ORDER BY n DESC, l DESC LIMIT 1",
    "keywords_with_sentiment": f"WITH {SCORED}, {_tfidf()}, {_top_terms(20)}, best15 AS (SELECT * FROM best WHERE rank <= 15), {_keyword_sentiment('contains(clean, term)', 'best15')}, "
    f"k AS (SELECT term, {_r('score / max(score) OVER () * 100', 1)} AS score FROM best) "
    f"SELECT row_number() OVER (ORDER BY k.score DESC, k.term) AS rank, k.term AS keyword, k.score, coalesce({_label('mean')}, 'neutral') AS sentiment, coalesce({_r('mean', 4)}, 0) AS avg_sentiment FROM k LEFT JOIN means USING (term)",
    "weekly_trend_join": f"WITH {SCORED}, {WEEKS} SELECT strftime(week, '%Y-%m-%d') AS week, {_r('mean', 4)} AS avg_sentiment, n AS article_count FROM weeks",
    "daily_volume": "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS articles FROM documents JOIN events ON event_id = doc_id GROUP BY 1",
    "top_entities": f"WITH {_mentions('text', 'documents')} SELECT entity_type, rank, name, mentions FROM placed WHERE rank <= 2",
    "source_metric_pivot": f"WITH {SCORED}, {RECIPES} SELECT 'web_articles' AS source, {_r('avg(compound_score)', 4)} AS avg_sentiment, NULL::DOUBLE AS avg_spoonacular_score, NULL::DOUBLE AS avg_health_score, count(*)::DOUBLE AS record_count FROM scored UNION ALL SELECT 'api_recipes', NULL, {_r('avg(spoonacularScore)', 4)}, {_r('avg(healthScore)', 4)}, count(*)::DOUBLE FROM recipes",
    "trending_recipes": f"WITH {RECIPES}, {SEARCH_WORDS}, {_alignment('recipes')} SELECT id::VARCHAR AS recipe_id, title, hits::DOUBLE AS trend_score, spoonacularScore AS score, CASE WHEN hits > 0 THEN shown END AS matched FROM aligned ORDER BY hits DESC, spoonacularScore DESC, id::VARCHAR LIMIT 25",
    "narrative_summary": f"WITH {SCORED}, {RECIPES}, {DISTRIBUTION}, {FLAGS}, {_tfidf()}, {_top_terms(20)} SELECT *, 'Talk of the week: ' || top_keyword || '; ' || pct_positive || '% of the coverage is positive. Recipes to go with it: ' || recipe_count || '. Leading diet: ' || top_diet_label || '.' AS narrative FROM (SELECT (SELECT term FROM best WHERE rank = 1) AS top_keyword, (SELECT floor(pct)::BIGINT FROM labels_ WHERE l = 'positive') AS pct_positive, (SELECT count(*) FROM recipes) AS recipe_count, (SELECT flag FROM flags ORDER BY n DESC, flag LIMIT 1) AS top_diet, (SELECT name || ': ' || pct || '% of recipes' FROM flags ORDER BY n DESC, flag LIMIT 1) AS top_diet_label)",
}

_ANCHOR = f"""
parts AS (SELECT unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings WHERE label = {q.SEED_LABEL}),
means AS (SELECT i, avg(x) AS x FROM parts GROUP BY 1),
anchor AS (SELECT i, x / ((SELECT sqrt(sum(x * x)) FROM means) + 1e-8) AS x FROM means)
"""
ORACLE["vector_anchor"] = f"WITH {_ANCHOR} SELECT i - 1 AS pos, {_r('x', 6)} AS x FROM anchor"
ORACLE["vector_vocab_filter"] = f"""
WITH {_ANCHOR},
each AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
sims AS (SELECT vec_id, label, sum(v * x) / ((sqrt(sum(v * v)) + 1e-8) * ((SELECT sqrt(sum(x * x)) FROM anchor) + 1e-8)) AS s
         FROM each JOIN anchor USING (i) GROUP BY 1, 2)
SELECT vec_id, label, {_r('s', 6)} AS similarity FROM sims WHERE s > {q.COSINE} OR label = 1
"""
ORACLE["topic_terms"] = f"""
WITH {ARTICLES}, {_tfidf()},
named AS (SELECT term, row_number() OVER (ORDER BY total DESC, term) - 1 AS vec_id FROM scores),
vecs AS (SELECT term, embedding FROM embeddings JOIN named USING (vec_id)),
parts AS (SELECT unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM vecs WHERE term IN ('was', 'for', 'on')),
means AS (SELECT i, avg(x) AS x FROM parts GROUP BY 1),
each AS (SELECT term, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS v FROM vecs),
sims AS (SELECT term, sum(v * x) / (sqrt(sum(v * v)) * (SELECT sqrt(sum(x * x)) FROM means)) AS s FROM each JOIN means USING (i) GROUP BY 1)
SELECT term FROM sims WHERE s > {q.COSINE} UNION SELECT term FROM scores WHERE term IN ('that', 'with')
"""
