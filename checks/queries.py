"""Spark side of the registered queries: name -> function of the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks import parameters as q
from checks.tables import TEXT, Tables
from trendlake.functions import nested, text, values
from trendlake.operators import dedupe, entities, keywords, profile, search, sketches, substring, trends
from trendlake.operators.quantiles import exact_quantiles
from trendlake.operators.sentiment import add_sentiment
from trendlake.plans import gold, serving, silver
from trendlake.plans.governance import ingestion_facts, reject_facts
from trendlake.session import shared_folder, written_once
from trendlake.sources import batches, drift, landed, partitions, schemas, sinks
from trendlake.streaming import articles as articles_stream
from trendlake.streaming.articles import weekly_windows

REGISTRY: dict = {}
ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
    "labels", "conversations",
)


def query(function):
    REGISTRY[function.__name__] = function
    return function


def facts(df: DataFrame) -> DataFrame:
    return df.drop("computed_at")


# --- cleaning -----------------------------------------------------------------

@query
def clean_text(t: Tables):
    return t["documents"].select("doc_id", text.clean_text(F.col("text"), q.STOP_WORDS).alias("clean"))


@query
def clean_articles(t: Tables):
    return t.articles().select("article_id", "article_title", "article_title_clean", TEXT)


@query
def unescape_title(t: Tables):
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return t["pages"].select("page_id", text.unescape_html(title).alias("title"))


@query
def strip_html(t: Tables):
    return t["pages"].select("page_id", text.strip_html(F.col("html")).alias("visible"))


@query
def strip_tags_simple(t: Tables):
    return t["pages"].select("page_id", text.strip_tags_simple(F.col("html")).alias("plain"))


@query
def photo_attribution(t: Tables):
    return t["documents"].select("doc_id", text.remove_photo_credit(F.col("text")).alias("body"))


@query
def list_to_csv(t: Tables):
    turns = t["conversations"].groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return nested.flatten_arrays(turns)


@query
def ingredient_names(t: Tables):
    named = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    item = F.struct(F.col("l_linenumber").alias("number"), F.col("p_partkey").alias("part"),
                    F.when(F.col("l_quantity") > 5, F.col("p_name")).alias("name"))
    lists = named.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return lists.select("l_orderkey", nested.ingredient_names(F.col("items")).alias("names"))


@query
def instruction_text(t: Tables):
    step = F.struct("turn", F.when(F.col("role") != "system", F.col("text")).alias("step"))
    blocks = t["conversations"].groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    return blocks.select("conv_id", nested.instruction_text(F.array(F.struct("steps"))).alias("instructions"))


@query
def number_coercion(t: Tables):
    return t["documents"].select(
        "doc_id", values.to_int(F.substring("source", 4, 9)).alias("number"), values.to_int(F.col("lang")).alias("none")
    )


@query
def flag_tags(t: Tables):
    tags = nested.flag_tags({"vegetarian": "vegetarian", "vegan": "vegan", "glutenFree": "gluten_free", "dairyFree": "dairy_free"})
    return t.recipes().select("id", F.array_join(tags, "|").alias("tags"))


@query
def default_text(t: Tables):
    labels = t["labels"].select("doc_id", F.when(F.col("quality") == 1, F.lit(" good ")).alias("note"))
    joined = t["documents"].select("doc_id").join(labels, "doc_id", "left")
    return joined.select("doc_id", values.default_text(F.col("note"), "Untitled").alias("note"))


@query
def published_dates(t: Tables):
    rows = t.dated_articles().select("article_id", values.parse_published(F.col("published_date")).alias("at"))
    return rows.select("article_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


@query
def safe_names(t: Tables):
    return t["customer"].select("c_custkey", text.slug(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("slug"))


@query
def search_names(t: Tables):
    name = text.search_name(F.col("p_name"), F.col("p_type"), F.when(F.col("p_size") > 25, F.lit("a,b")).otherwise(F.lit("")))
    return t["part"].select("p_partkey", name.alias("name"))


@query
def filled_text(t: Tables):
    joined = t["documents"].select("doc_id").join(
        t["labels"].select("doc_id", F.when(F.col("toxic") == 0, "clean").alias("state"), "quality"), "doc_id", "left"
    )
    return values.fill_text(joined)


# --- quality ------------------------------------------------------------------

@query
def null_rate(t: Tables):
    joined = t["documents"].join(t["labels"], "doc_id", "left")
    return facts(profile.null_rates(joined, "webscraping", q.RUN_TS))


@query
def null_overview(t: Tables):
    return profile.null_overview(t["documents"].join(t["labels"], "doc_id", "left"), "web")


@query
def record_count(t: Tables):
    return facts(profile.record_count(t["lineitem"], "api", q.RUN_TS))


@query
def duplicate_rate_key(t: Tables):
    return facts(dedupe.duplicate_rate(t["lineitem"], "l_partkey", "api", q.RUN_TS))


@query
def duplicate_rate_text(t: Tables):
    return facts(dedupe.duplicate_rate(t["documents"], "text", "webscraping", q.RUN_TS))


@query
def full_row_duplicates(t: Tables):
    """All columns, over the documents and a second copy of those in other languages than English."""
    docs = t["documents"]
    return dedupe.full_row_duplicates(docs.unionByName(docs.filter("lang <> 'en'")))


@query
def dedupe_keep_first(t: Tables):
    return dedupe.keep_first(t["documents"], ["text"], ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


@query
def curated_articles(t: Tables):
    return t.curated().select("article_id", "article_title", "categories", "source", "author")


@query
def outlier_rate_disc(t: Tables):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return facts(profile.outlier_rates(t["lineitem"], columns, "api", q.RUN_TS, "discrete"))


@query
def outlier_rate_exact(t: Tables):
    return profile.outlier_report(t["lineitem"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query
def outlier_rate_balance(t: Tables):
    return profile.outlier_report(t["customer"], ["c_acctbal"])


@query
def text_length_stats(t: Tables):
    rows = facts(profile.text_profile(t["documents"], ["text"], "webscraping", q.RUN_TS))
    return rows.withColumn("value", values.half_up(F.col("value"), 3))


@query
def text_length_describe(t: Tables):
    return profile.text_length_describe(t["pages"], ["url", "html"])


@query
def compression_ratio(t: Tables):
    rows = profile.compression_ratio(t.articles(), "article_summary", TEXT, "webscraping", q.RUN_TS)
    return facts(rows)


@query
def outlier_rate_sketch(t: Tables):
    """Whether quartiles of sketches lie at their rank, give or take the stated error; also of sketches for each day, merged."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = t["lineitem"]
    whole = sketches.column_sketches(lines, columns)
    daily = written_once(sketches.column_sketches(lines, columns, ["l_shipdate"]))
    kinds = [("whole", whole), ("daily", sketches.merged(daily))]
    quartiles = drift.union_all([
        s.select(F.lit(kind).alias("kind"), "field", "n", F.explode(F.array(*[
            F.struct(F.lit(p).alias("p"), sketches.quantile_of(F.col("sketch"), p).alias("v")) for p in (0.25, 0.75)
        ])).alias("q")).select("kind", "field", "n", "q.*") for kind, s in kinds
    ])
    values_ = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("x")) for c in columns])))
    ranks = values_.groupBy("field", "x").agg(F.count("*").alias("m")).join(quartiles, "field").groupBy("kind", "field", "n", "p").agg(
        F.sum(F.when(F.col("x") < F.col("v"), F.col("m")).otherwise(0)).alias("below"), F.sum(F.when(F.col("x") <= F.col("v"), F.col("m")).otherwise(0)).alias("upto")
    )
    error = F.lit(sketches.RANK_ERROR)
    inside = (F.col("below") <= (F.col("p") + error) * F.col("n")) & (F.col("upto") >= (F.col("p") - error) * F.col("n"))
    return ranks.select("kind", "field", "p", "n", inside.alias("inside"))


@query
def outlier_rate_approximate(t: Tables):
    """The job's default: rates by the fences of one sketch, give or take what the error of a quartile can move."""
    columns = ["l_quantity", "l_discount", "l_tax"]
    return facts(profile.outlier_rates(t["lineitem"], columns, "api", q.RUN_TS)).select("kpi_name", "source", "field", "value")


@query
def describe_numeric(t: Tables):
    return profile.describe_numeric(t["lineitem"], ["l_quantity", "l_extendedprice", "l_discount"])


def _nan_prices(t: Tables) -> DataFrame:
    price = F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice")).otherwise(F.lit("NaN").cast("double"))
    return t["lineitem"].select(price.alias("price"), "l_quantity")


@query
def describe_with_nan(t: Tables):
    return profile.describe_numeric(_nan_prices(t), ["price", "l_quantity"])


@query
def outlier_report_with_nan(t: Tables):
    return profile.outlier_report(_nan_prices(t), ["price"])


@query
def exact_medians(t: Tables):
    """Quartiles of every order price, discrete and interpolated."""
    orders = t["orders"]
    cont = exact_quantiles(orders, ["o_totalprice"], [0.1, 0.5, 0.9])["o_totalprice"]
    disc = exact_quantiles(orders, ["o_totalprice"], [0.1, 0.5, 0.9], interpolate=False)["o_totalprice"]
    rows = [(p, round(c, 4), d) for p, c, d in zip((0.1, 0.5, 0.9), cont, disc)]
    return t.spark.createDataFrame(rows, "p double, cont double, disc double")


@query
def schema_compliance(t: Tables):
    return facts(profile.schema_compliance(t["documents"], q.EXPECTED_COLUMNS, "webscraping", q.RUN_TS))


@query
def target_coverage(t: Tables):
    targets = t.spark.createDataFrame([(n,) for n in q.TARGETS], "name string")
    found = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"))
    return facts(profile.target_coverage(targets, found, "name", "api", q.RUN_TS))


# --- sentiment and trends -----------------------------------------------------

@query
def sentiment_score(t: Tables):
    return t.scored().select("article_id", "compound_score", "sentiment_label")


@query
def sentiment_large_lexicon(t: Tables):
    """A lexicon of most words of the articles, far beyond what becomes a constant."""
    articles = t.stored_articles()
    words = articles.select(F.explode(text.tokens_of(F.col(TEXT))).alias("token")).distinct()
    length = F.length("token")
    lexicon = written_once(words.filter(length % 3 != 0).withColumn("valence", ((length * 7) % 41 - 20) / F.lit(4.0)))
    scored = add_sentiment(articles, TEXT, lexicon, boosters=q.BOOSTERS, negations=q.NEGATIONS, limit=1_000)
    return scored.select("article_id", "compound_score", "sentiment_label")


@query
def sentiment_distribution(t: Tables):
    return facts(trends.sentiment_distribution(t.scored(), q.RUN_TS))


@query
def sentiment_trend_weekly(t: Tables):
    return facts(trends.sentiment_trend(t.scored(dated=True), q.RUN_TS))


@query
def weekly_windows_batch(t: Tables):
    events = t["events"].select("ts", F.col("value").alias("compound_score"))
    return weekly_windows(events, "ts").withColumn("week", F.date_format("week", "yyyy-MM-dd"))


@query
def volume_daily(t: Tables):
    rows = t["events"].select(F.col("ts").alias("published_date"))
    return facts(trends.volume_trends(rows, q.RUN_TS))


@query
def category_breakdown(t: Tables):
    return facts(trends.category_breakdown(t.scored(), q.RUN_TS))


@query
def flag_breakdown(t: Tables):
    return facts(trends.flag_breakdown(t.recipes(), q.RUN_TS))


@query
def source_comparison(t: Tables):
    return facts(trends.source_comparison(t.scored(), t.recipes(), q.RUN_TS))


@query
def buzz_words(t: Tables):
    return trends.buzz_words(t.stored_scored(), TEXT)


@query
def trend_alignment(t: Tables):
    terms = t.spark.createDataFrame([(i + 1, w) for i, w in enumerate(q.SEARCH_WORDS)], "rank int, term string")
    return facts(trends.trend_alignment(t.recipes(), terms, q.RUN_TS))


@query
def trend_alignment_articles(t: Tables):
    """Buzz words of the articles matched against conversation turns."""
    turns = t["conversations"].select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("title"), F.col("role").alias("cuisines"),
        F.lit(None).cast("string").alias("dishTypes"), F.length("text").alias("spoonacularScore"), F.col("turn").alias("aggregateLikes"),
    )
    rows = facts(trends.trend_alignment(turns, trends.buzz_words(t.stored_scored(), TEXT), q.RUN_TS))
    return rows.filter(F.col("metric").isin("trend_score", "matched_keywords")).select(
        "dimension_value", "metric", "value", F.when(F.col("metric") == "matched_keywords", F.col("label")).alias("label")
    )


# --- vocabulary ---------------------------------------------------------------

@query
def tfidf_scores(t: Tables):
    rows = keywords.tfidf_scores(t.stored_articles(), TEXT)
    return rows.select("term", "total", values.half_up(F.col("score"), 6).alias("score"))


@query
def tfidf_top_keywords(t: Tables):
    return facts(keywords.top_keywords(keywords.top_terms(t.stored_articles(), TEXT, 20), q.RUN_TS))


@query
def tfidf_topic_keywords(t: Tables):
    rows = keywords.trending_keywords(t.stored_articles(), [TEXT, "article_title_clean"], 10, q.VOCABULARY)
    return rows.select("rank", "term", values.half_up(F.col("score"), 6).alias("score"))


@query
def frequency_keywords(t: Tables):
    """Fewer than three topic words pass, so the frequency ranking is used."""
    rows = keywords.trending_keywords(t.stored_articles(), [TEXT, "article_title_clean"], 10, ["that", "absent"])
    return rows.select("rank", "term", "score")


@query
def top_bigrams(t: Tables):
    return facts(keywords.top_bigrams(written_once(t.articles().select(TEXT)), TEXT, q.RUN_TS))


@query
def conversation_bigrams(t: Tables):
    turns = t["conversations"].select(text.clean_text(F.col("text"), []).alias("clean"))
    return keywords.frequent_bigrams(written_once(turns), "clean", 50)


@query
def keyword_sentiment(t: Tables):
    scored = t.stored_scored()
    return facts(keywords.keyword_sentiment(scored, TEXT, keywords.top_terms(scored, TEXT, 15), q.RUN_TS))


@query
def keyword_sentiment_words(t: Tables):
    scored = t.stored_scored()
    terms = keywords.top_terms(scored, TEXT, 15)
    return facts(keywords.keyword_sentiment(scored, TEXT, terms, q.RUN_TS, whole_words=True))


@query
def entity_counts(t: Tables):
    return entities.entity_counts(t["documents"], "text", t.gazetteer())


@query
def entity_top_titles(t: Tables):
    return facts(entities.named_entities(t.raw_articles(), "article_title", t.gazetteer(), q.RUN_TS, 2))


@query
def entity_top_combined(t: Tables):
    joined = t.raw_articles().withColumn("both", entities.entity_text("article_title", "article_summary"))
    return entities.top_entities(entities.entity_counts(joined, "both", t.gazetteer()), 10).select(
        "entity_type", "rank", "name", "mentions"
    )


@query
def vector_anchor(t: Tables):
    anchor = keywords.anchor_vector(t["embeddings"], F.col("label") == q.SEED_LABEL, "embedding")
    return anchor.select(F.posexplode("anchor")).select("pos", values.half_up(F.col("col"), 6).alias("x"))


@query
def vector_vocab_filter(t: Tables):
    near = keywords.vector_similarity(t["embeddings"], F.col("label") == q.SEED_LABEL, "embedding")
    kept = near.filter((F.col("similarity") > q.COSINE) | F.col("label").isin(1))
    return kept.select("vec_id", "label", values.half_up(F.col("similarity"), 6).alias("similarity"))


@query
def topic_terms(t: Tables):
    """Words of the documents with a vector: word number n of the ranking gets vector n."""
    order = Window.orderBy(F.desc("total"), "term")
    scores = keywords.tfidf_scores(t.stored_articles(), TEXT)
    named = scores.withColumn("vec_id", F.row_number().over(order) - 1)
    vectors = t["embeddings"].join(named, "vec_id").select("term", F.col("embedding").alias("vec"))
    return keywords.topic_terms(scores, ["that", "with"], vectors, ["was", "for", "on"], q.COSINE)


# --- search -------------------------------------------------------------------

@query
def keyword_search_topn(t: Tables):
    terms = t.spark.createDataFrame([(w,) for w in q.SEARCH_WORDS], "term string")
    hits = search.search_by_keywords(terms, t.recipes(), ["title", "cuisines"], 5)
    return hits.select("query", "rank", "id", "title")


@query
def keyword_search_mixed_case(t: Tables):
    """Each keyword in several spellings and an empty one: one query each, and none."""
    spellings = [w for word in q.SEARCH_WORDS for w in (word, word.upper(), word.title())]
    terms = t.spark.createDataFrame([(w,) for w in [*spellings, ""]], "term string")
    return search.search_by_keywords(terms, t.recipes(), ["title", "cuisines"], 5).select("query", "rank", "id")


def _piece_terms(t: Tables) -> DataFrame:
    """Pieces of part names, one to six characters long, and all part numbers: thousands of terms, many of them in texts."""
    key = F.col("p_partkey")
    pieces = t["part"].select(F.substring(F.col("p_name"), (1 + key % 7).cast("int"), (1 + key % 6).cast("int")).alias("term"))
    return pieces.union(t["part"].select(key.cast("string"))).distinct()


@query
def substring_terms(t: Tables):
    """Documents that contain each of a long list of terms."""
    def totals(hits: DataFrame) -> DataFrame:
        return hits.groupBy("term").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))

    docs = t["documents"].select("text", F.length("text").alias("chars"))
    return substring.per_term(docs, "text", _piece_terms(t), totals)


@query
def keyword_sentiment_long_list(t: Tables):
    means = keywords.keyword_means(t.stored_scored(), TEXT, _piece_terms(t))
    return means.select("term", "documents", F.round(F.col("mean") * F.col("documents") * 10000).cast("long").alias("total"))


@query
def alignment_long_list(t: Tables):
    """Recipes beside a list of a few hundred ranked words."""
    words = _piece_terms(t).filter(F.length("term") > 2).select(F.length("term").alias("rank"), "term")
    matched = trends.match_words(t.recipes(), ["title", "cuisines", "dishTypes"], words)
    return matched.select("id", F.size("matches").alias("hits"), F.array_join("matches", "|").alias("found"))


@query
def keyword_search_long_list(t: Tables):
    return search.search_by_keywords(_piece_terms(t), t.recipes(), ["title", "cuisines"], 3).select("query", "rank", "id")


@query
def conversation_search(t: Tables):
    terms = keywords.top_terms(t.stored_articles(), TEXT, 10)
    turns = t["conversations"].select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text", F.length("text").alias("spoonacularScore")
    )
    return search.search_by_keywords(terms, turns, ["text"], 5).select("query", "rank", "id")


@query
def ingredient_search(t: Tables):
    return search.search_by_ingredients(q.INGREDIENTS, t.recipes(), 10).select("query", "rank", "id")


@query
def ingredient_search_diet(t: Tables):
    hits = search.search_by_ingredients(q.INGREDIENTS, t.recipes(), 10, diet="vegan|dairy free", intolerances="gluten")
    return hits.select("query", "rank", "id")


@query
def missing_keys(t: Tables):
    return search.missing_keys(t["documents"].select("doc_id"), t["labels"], "doc_id")


@query
def recipe_filter_rank(t: Tables):
    rows = search.recipe_list(t.recipes(), 20, cuisine="conom", diet="vegetarian", max_minutes=18)
    return rows.select("rank", "total", "id", "title", "cuisines", "readyInMinutes", "spoonacularScore")


@query
def recipe_list_all(t: Tables):
    return search.recipe_list(t.recipes()).select("rank", "total", "id", "title")


@query
def point_lookup(t: Tables):
    return search.recipe_by_id(t.recipes(), 42)


# --- partitions and batches ---------------------------------------------------

@query
def latest_partition(t: Tables):
    rows = partitions.newest(t["events"], F.to_date("ts"))
    return rows.select("event_id", "user_id", "event_type", "value")


@query
def latest_run(t: Tables):
    return partitions.newest(t["orders"], "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def feed_cap(t: Tables):
    rows = t["events"].withColumns({landed.SOURCE_FILE: F.col("event_type"), landed.POSITION: F.col("event_id")})
    return landed.cap_per_feed(rows).select("event_id", "event_type")


@query
def ingestion_inventory(t: Tables):
    rows = partitions.inventory(t.event_files())
    return rows.select("source", "distinct_dates", "files", "latest_files", F.col("latest_date").cast("string").alias("latest_date"))


@query
def ingestion_frequency(t: Tables):
    return facts(ingestion_facts(t.event_files(), q.RUN_TS))


@query
def retention_plan(t: Tables):
    names = t["orders"].select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("name")).distinct()
    plan = partitions.retention_plan(names, q.TODAY)
    return plan.select("name", "status")


@query
def batch_set_equality(t: Tables):
    def batch(status: str) -> DataFrame:
        return t["orders"].filter(F.col("o_orderstatus") == status).select(
            F.year("o_orderdate").alias("day"), F.col("o_custkey").alias("batch"), F.col("o_orderpriority").alias("id")
        )

    return batches.repeated_batches(batch("O"), batch("F"), "batch", "day", "id")


@query
def batch_skip(t: Tables):
    def batch(parity: int) -> DataFrame:
        return t["lineitem"].filter(F.col("l_orderkey") % 2 == parity).select(
            F.col("l_returnflag").alias("day"), F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("id")
        )

    kept = batches.skip_repeated_batches(batch(0), batch(1), "batch", "day", "id")
    return kept.groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("batch").alias("batches"))


@query
def union_by_name(t: Tables):
    a = t["documents"].select(F.col("doc_id").alias("id"), "lang")
    b = t["conversations"].select(F.col("conv_id").alias("id"), "role")
    return drift.union_all([a, b]).groupBy("lang", "role").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query
def run_summary(t: Tables):
    """Rows and files of every table."""
    return partitions.table_summary({name: t.scan(name) for name in ALL_TABLES})


# --- landing ------------------------------------------------------------------
# Payloads are made of the tables' rows and read by the schemas and rules of the landed files.

def _recipe_payloads(t: Tables) -> DataFrame:
    """One ``results`` payload for each brand and size, with list columns as lists."""
    lists = {c: F.split(c, ", ") for c in ("cuisines", "dishTypes", "diets")}
    parts = F.transform(F.split("ingredient_names", ", "), lambda n: F.struct(n.alias("name")))
    steps = F.array(F.struct(F.array(F.struct(F.col("title").alias("step")), F.struct(F.lit("Serve.").alias("step"))).alias("steps")))
    recipes = t.recipes().withColumns(lists).withColumns({
        "extendedIngredients": parts, "analyzedInstructions": steps,
        "summary": F.concat(F.lit("<b>"), "title", F.lit("</b> for &amp; all")), "preparationMinutes": F.col("readyInMinutes").cast("string"),
        "cookingMinutes": F.concat(F.col("readyInMinutes").cast("string"), F.lit("d")),
    }).drop("ingredient_names")
    one = recipes.select("dishTypes", "readyInMinutes", F.struct(*recipes.columns).alias("recipe"))
    files = one.groupBy("dishTypes", "readyInMinutes").agg(F.to_json(F.struct(F.collect_list("recipe").alias("results"))).alias("body"))
    name = F.concat_ws("-", F.get("dishTypes", 0), "readyInMinutes").alias(landed.SOURCE_FILE)
    return files.select(F.from_json("body", schemas.RECIPE_FILE)["results"].alias("results"), name)


@query
def recipe_payload_rows(t: Tables):
    rows = landed.recipe_rows(_recipe_payloads(t))
    return rows.select(
        "id", "title", F.array_join("cuisines", "|").alias("cuisines"), "spoonacularScore", "healthScore", "readyInMinutes", "vegetarian",
        F.array_join(F.col("extendedIngredients.name"), "|").alias("ingredients"), "cookingMinutes", "license", landed.SOURCE_FILE,
    )


@query
def silver_recipes(t: Tables):
    rows = silver.silver_recipes(landed.recipe_rows(_recipe_payloads(t)))
    return rows.select(
        "id", "title", "cuisines", "dishTypes", "diets", "preparationMinutes", "cookingMinutes", "ingredient_names", "instructions_text",
        "summary", "license",
    )


@query
def gold_recipes(t: Tables):
    """Every recipe lands twice; one stays."""
    rows = silver.silver_recipes(landed.recipe_rows(_recipe_payloads(t)))
    curated = gold.gold_recipes(rows.unionByName(rows))
    return curated.select("id", "title", "cuisines", "vegetarian", "ingredient_names", F.array_join("dietary_tags", "|").alias("tags"))


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({landed.SOURCE_FILE: F.lit("feed"), landed.POSITION: F.col("doc_id")})


def _article_payloads(t: Tables) -> DataFrame:
    """Each document as a payload of one article, in two files."""
    body = F.to_json(F.struct(
        F.col("source"), F.regexp_extract("text", r"^[^.\n]*", 0).alias("article_title"), F.col("doc_id").cast("string").alias("article_id"),
        F.col("lang").alias("author"), F.col("text").alias("article_summary"), F.array("source", "lang").alias("categories"),
    ))
    parsed = t["documents"].select("doc_id", F.from_json(body, schemas.ARTICLE_FILE).alias("a"))
    rows = parsed.select("a.*", "doc_id", F.explode(F.array(F.lit("b.json"), F.lit("a.json"))).alias(landed.SOURCE_FILE))
    return rows.withColumnRenamed("doc_id", landed.POSITION)


@query
def article_payload_rows(t: Tables):
    rows = _article_payloads(t)
    return rows.select("article_id", "article_title", "article_summary", F.array_join("categories", "|").alias("categories"), "author", landed.SOURCE_FILE)


@query
def silver_articles(t: Tables):
    """Each article lands in two files; the first one stays and is cleaned."""
    rows = silver.silver_articles(_article_payloads(t), q.STOP_WORDS)
    return rows.select("article_id", "article_title", "article_title_clean", TEXT, "author")


def _element(tag: str, value):
    escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.concat(F.lit(f"<{tag}>"), escaped, F.lit(f"</{tag}>"))


_ARTICLE = ["article_id", "article_title", "article_url", "author", "published_date", "article_summary", "source", "location_focus"]


@query
def rss_rows(t: Tables):
    """Parts as feed items; small ones lack a title, large ones carry the long text."""
    name, size = F.col("p_name"), F.col("p_size")
    item = F.concat(
        F.lit("<item>"), F.when(size > 3, _element("title", name)).otherwise(""), _element("link", F.concat(F.lit("http://x/?a&b="), F.col("p_partkey").cast("string"))),
        _element("guid", F.col("p_partkey").cast("string")), _element("pubDate", F.lit("Tue, 26 May 2026 10:11:12 GMT")),
        _element("description", F.concat(F.lit("<p>Short  "), name, F.lit("</p>"))),
        F.when(size > 40, _element("content:encoded", F.concat(F.lit("<b>Long</b> "), name))).otherwise(""),
        _element("category", F.col("p_brand")), _element("category", F.lit("")), _element("category", F.col("p_type")), F.lit("</item>"),
    )
    parsed = t["part"].select("p_partkey", F.from_xml(item, schemas.RSS_ITEM).alias("i")).select("i.*", F.col("p_partkey").alias("doc_id"))
    rows = landed.rss_articles(_stamped(parsed), "feed", F.lit("20260527_080000"))
    return rows.select(*_ARTICLE, F.array_join("categories", "|").alias("categories"))


@query
def atom_rows(t: Tables):
    """Parts as feed entries; the alternate link counts, the update time stands in for a missing publication."""
    name, key = F.col("p_name"), F.col("p_partkey").cast("string")
    entry = F.concat(
        F.lit("<entry>"), _element("title", name), _element("id", key), F.lit("<author>"), _element("name", F.col("p_brand")), F.lit("</author>"),
        F.when(F.col("p_size") > 25, _element("published", F.lit("2026-05-26T10:11:12-04:00"))).otherwise(""), _element("updated", F.lit("2026-05-27")),
        F.lit('<link rel="self" href="http://s/"/><link rel="alternate" href="http://x/'), key, F.lit('"/>'), _element("summary", F.concat(F.lit("<i>"), name, F.lit("</i>"))),
        F.lit('<category term="'), F.col("p_type"), F.lit('"/></entry>'),
    )
    parsed = t["part"].select("p_partkey", F.from_xml(entry, schemas.ATOM_ENTRY).alias("e")).select("e.*", F.col("p_partkey").alias("doc_id"))
    rows = landed.atom_articles(_stamped(parsed), "feed", F.lit("20260527_080000"))
    return rows.select(*_ARTICLE, F.array_join("categories", "|").alias("categories"))


def _broken_payloads(t: Tables) -> DataFrame:
    """A payload for each document, of which some are cut off, some lack results, and some are of another type."""
    key = F.col("doc_id")
    whole = F.to_json(F.struct(F.array(F.struct(key.alias("id"), F.col("source").alias("title"), F.col("lang").alias("image"))).alias("results")))
    body = (
        F.when(key % 7 == 0, F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int")))
        .when(key % 11 == 0, '{"status": "failure", "code": 402}').when(key % 13 == 0, "<html>busy</html>").otherwise(whole)
    )
    return t["documents"].select(body.alias("body"), F.concat(F.lit("p"), key).alias(landed.SOURCE_FILE))


@query
def rejected_payloads(t: Tables):
    payloads = landed.parsed(_broken_payloads(t), "body", schemas.RECIPE_FILE)
    return landed.rejected(payloads.select("results", landed.CORRUPT, landed.SOURCE_FILE), "api", "results").drop("digest")


@query
def accepted_payload_rows(t: Tables):
    payloads = landed.parsed(_broken_payloads(t), "body", schemas.RECIPE_FILE)
    rows = landed.recipe_rows(landed.accepted(payloads.select("results", landed.CORRUPT, landed.SOURCE_FILE)))
    return rows.select("id", "title", F.col("image").alias("lang"), F.col(landed.SOURCE_FILE).alias("file"))


@query
def reject_rate(t: Tables):
    payloads = landed.parsed(_broken_payloads(t), "body", schemas.RECIPE_FILE)
    return facts(reject_facts(landed.rejected(payloads.select("results", landed.CORRUPT, landed.SOURCE_FILE), "api", "results"), q.RUN_TS))


@query
def landed_newest_day(t: Tables):
    """Files of each source's newest day: here orders by status."""
    files = t["orders"].select(F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("dt"), F.col("o_orderkey").alias("path"))
    return partitions.newest_of_each(files).select("source", F.col("dt").cast("string").alias("dt"), "path")


@query
def publish_round_trip(t: Tables):
    """Orders published by status in two runs, the second one left uncommitted: readers see the first."""
    folder = f"{shared_folder(t.spark)}/published-{uuid.uuid4()}"
    orders = t["orders"].select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    parts = {f"orders_{s.lower()}": orders.filter(F.col("o_orderstatus") == s) for s in ("O", "F", "P")}
    sinks.publish_snapshot(t.spark, parts, folder)
    sinks.stage_snapshot({name: df.limit(1) for name, df in parts.items()}, folder, sinks.new_run())
    rows = drift.union_all([sinks.read_published(t.spark, folder, name).withColumn("table", F.lit(name)) for name in parts])
    return rows.groupBy("table", F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


@query
def streamed_articles(t: Tables):
    """Documents land in two parts, the second with copies of the first, and are streamed after each and once more."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4()}"
    key = F.col("article_id")
    landed_rows = t.raw_articles().select(
        key.cast("string").alias("article_id"), "article_title", "article_summary", "source", "author",
        F.date_format(F.timestamp_seconds(1_780_000_000 + key), "yyyyMMdd_HHmmss").alias("date_extracted"),
    )
    for part, rows in (("one", landed_rows.filter(key % 2 == 0)), ("two", landed_rows), ("two", landed_rows.limit(0))):
        rows.write.mode("append").json(f"{folder}/landed/{part}")
        stream = articles_stream.stream_articles(t.spark, f"{folder}/landed", multi_line=False)
        articles_stream.start_ingest(stream, q.STOP_WORDS, f"{folder}/table", f"{folder}/state").awaitTermination()
    stored = t.spark.read.parquet(f"{folder}/table")
    return stored.select(F.col("article_id").cast("long").alias("article_id"), "source", F.length("article_summary_clean").alias("chars"))


# --- serving ------------------------------------------------------------------

@query
def governance_job(t: Tables):
    """All KPIs of the daily job: nulls, volume, duplicates, schema, outliers, texts, compression, coverage, files, ingestion."""
    return facts(t.governance_job())


@query
def governance_rows(t: Tables):
    rows = serving.fact_rows(t.governance()).withColumn("partition_date", F.col("partition_date").cast("string"))
    return rows.select("kpi_name", "category", "source", "field", "value", "unit", "finding", "partition_date", "row_count")


@query
def kpi_summary(t: Tables):
    return serving.kpi_summary(t.governance())


@query
def null_rates_severity(t: Tables):
    return serving.null_severity(t.governance(), 50.0, 20.0)


@query
def volume_by_source_day(t: Tables):
    return serving.volume_by_day(t.governance())


@query
def outliers_over_threshold(t: Tables):
    return serving.outliers_over(t.governance(), 1.0)


@query
def kpi_table(t: Tables):
    return serving.kpi_table(t.governance())


@query
def kpi_names_per_category(t: Tables):
    return serving.kpi_names_per_category(t.governance())


@query
def distinct_names(t: Tables):
    rows = serving.distinct_names(t.governance(), ["kpi_name", "category"])
    return rows.select(*[F.array_join(c, ",").alias(c) for c in rows.columns])


@query
def storytelling_rows(t: Tables):
    """All storytelling facts of articles and recipes with their row count."""
    rows = serving.fact_rows(t.story())
    return rows.select("aggregation", "category", "dimension_name", "dimension_value", "metric", "value", "label", "row_count")


def _sentiment_facts(t: Tables) -> DataFrame:
    return written_once(trends.sentiment_distribution(t.scored(), q.RUN_TS))


@query
def sentiment_with_percentages(t: Tables):
    return serving.sentiment(_sentiment_facts(t))


@query
def positive_share(t: Tables):
    return serving.positive_share(_sentiment_facts(t))


@query
def dominant_label(t: Tables):
    return serving.dominant_label(_sentiment_facts(t))


def _keyword_facts(t: Tables) -> DataFrame:
    scored = t.stored_scored()
    terms = keywords.top_terms(scored, TEXT, 20)
    return written_once(drift.union_all([
        keywords.top_keywords(terms, q.RUN_TS),
        keywords.keyword_sentiment(scored, TEXT, terms.filter("rank <= 15"), q.RUN_TS),
    ]))


@query
def keywords_with_sentiment(t: Tables):
    return serving.keywords(_keyword_facts(t), 20)


@query
def weekly_trend_join(t: Tables):
    return serving.sentiment_trend(written_once(trends.sentiment_trend(t.scored(dated=True), q.RUN_TS)))


@query
def daily_volume(t: Tables):
    return serving.daily_volume(written_once(trends.volume_trends(t.dated_articles(), q.RUN_TS)))


@query
def top_entities(t: Tables):
    return serving.entities(written_once(entities.named_entities(t["documents"], "text", t.gazetteer(), q.RUN_TS)), 2)


@query
def source_metric_pivot(t: Tables):
    return serving.source_metrics(written_once(trends.source_comparison(t.scored(), t.recipes(), q.RUN_TS)))


@query
def trending_recipes(t: Tables):
    terms = t.spark.createDataFrame([(i + 1, w) for i, w in enumerate(q.SEARCH_WORDS)], "rank int, term string")
    return serving.trending_recipes(written_once(trends.trend_alignment(t.recipes(), terms, q.RUN_TS)), 25)


@query
def narrative_summary(t: Tables):
    scored, recipes = t.stored_scored(), t.recipes()
    rows = drift.union_all([
        keywords.top_keywords(keywords.top_terms(scored, TEXT, 20), q.RUN_TS),
        trends.sentiment_distribution(scored, q.RUN_TS),
        trends.source_comparison(scored, recipes, q.RUN_TS),
        trends.flag_breakdown(recipes, q.RUN_TS),
    ])
    return serving.narrative_summary(written_once(rows))
