"""Queries over the fact tables; each reads the newest run and returns a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.functions.values import date_part, half_up, select_present, severity
from trendlake.operators.keywords import ranked
from trendlake.sources.partitions import newest

KPI_TABLE_COLUMNS = ["kpi_name", "category", "source", "field", "value", "unit", "finding"]
ENTITY_TYPES = ["restaurant", "neighborhood", "chef"]


def current(facts: DataFrame) -> DataFrame:
    """Rows of the newest run. Of a dated table only the newest partition is read for it."""
    if "dt" in facts.columns:
        facts = newest(facts, "dt").drop("dt")
    return newest(facts, "computed_at")


def fact_rows(facts: DataFrame) -> DataFrame:
    """All rows of the newest run with its date and the number of rows."""
    rows = current(facts)
    return rows.withColumn("partition_date", F.to_date("computed_at")).withColumn("row_count", rows.agg(F.count("*")).scalar())


def _where(facts: DataFrame, aggregation: str, metric: str | None = None) -> DataFrame:
    rows = facts.filter(F.col("aggregation") == aggregation)
    return rows if metric is None else rows.filter(F.col("metric") == metric)


def _value_if(condition: Column) -> Column:
    return F.max(F.when(condition, F.col("value")))


def kpi_summary(facts: DataFrame) -> DataFrame:
    """One row of headline KPIs."""
    def kpi(name: str) -> Column:
        return F.when(F.col("kpi_name") == name, F.col("value"))

    zero = F.lit(0.0)
    return current(facts).agg(
        F.coalesce(F.sum(kpi("record_count")), zero).cast("bigint").alias("total_records"),
        half_up(F.coalesce(F.max(kpi("null_rate")), zero), 2).alias("max_null_rate"),
        half_up(F.coalesce(F.max(kpi("duplicate_rate")), zero), 2).alias("duplicate_rate"),
        half_up(F.coalesce(F.min(kpi("schema_compliance_rate")), zero), 2).alias("schema_compliance_rate"),
    )


def null_rates(facts: DataFrame) -> DataFrame:
    """Fields with nulls, worst first."""
    rows = current(facts).filter((F.col("kpi_name") == "null_rate") & (F.col("value") > 0))
    return rows.select("source", "field", "value").orderBy(F.desc("value"), "source", "field")


def null_severity(facts: DataFrame, high: float = 80.0, medium: float = 20.0) -> DataFrame:
    return null_rates(facts).withColumn("severity", severity(F.col("value"), high, medium))


def volume_by_day(facts: DataFrame) -> DataFrame:
    """Records per source and run date, over all runs."""
    rows = facts.filter(F.col("kpi_name") == "record_count")
    return rows.groupBy("source", date_part(F.col("computed_at")).alias("date")).agg(F.sum("value").alias("value"))


def outliers_over(facts: DataFrame, threshold: float = 10.0) -> DataFrame:
    rows = current(facts).filter(F.col("kpi_name") == "outlier_rate")
    return rows.select("source", "field", "value", (F.col("value") > threshold).alias("over_threshold"))


def kpi_table(facts: DataFrame) -> DataFrame:
    """Display table of all KPIs."""
    rows = select_present(current(facts), KPI_TABLE_COLUMNS).withColumn("value", half_up(F.col("value"), 2))
    return rows.orderBy("category", "source", "kpi_name", "field")


def kpi_names_per_category(facts: DataFrame) -> DataFrame:
    return current(facts).groupBy("category").agg(F.count_distinct("kpi_name").alias("kpi_names"))


def distinct_names(facts: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the distinct values of low-cardinality name columns."""
    return current(facts).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])


def sentiment(facts: DataFrame) -> DataFrame:
    """Count and percentage per label with the overall mean score."""
    rows = _where(current(facts), "sentiment_distribution")
    labels = rows.filter(F.col("dimension_name") == "sentiment_label")
    wide = labels.groupBy(F.col("dimension_value").alias("label")).agg(
        _value_if(F.col("metric") == "count").cast("bigint").alias("count"),
        _value_if(F.col("metric") == "percentage").alias("percentage"),
    )
    mean = rows.agg(_value_if(F.col("metric") == "avg_compound_score"))
    return wide.withColumn("avg_compound_score", mean.scalar())


def positive_share(facts: DataFrame) -> DataFrame:
    """Whole percent of positive documents from the counts."""
    rows = _where(current(facts), "sentiment_distribution", "count")
    positive = F.sum(F.when(F.lower("dimension_value") == "positive", F.col("value")).otherwise(0.0))
    return rows.agg(F.floor(F.try_divide(positive, F.sum("value")) * 100).cast("bigint").alias("pct_positive"))


def dominant_label(facts: DataFrame) -> DataFrame:
    rows = _where(current(facts), "sentiment_distribution", "count")
    return rows.agg(F.max_by("dimension_value", F.struct("value", "dimension_value")).alias("label"), F.max("value").alias("value"))


def keywords(facts: DataFrame, limit: int = 15) -> DataFrame:
    """Best keywords with the sentiment label and mean score of their documents."""
    rows = current(facts)
    best = ranked(_where(rows, "top_keywords").select(F.col("label").alias("term"), F.col("value").alias("score")), limit, "score")
    tone = _where(rows, "keyword_sentiment").select(
        F.lower("dimension_value").alias("_key"), F.lower("label").alias("_tone"), F.col("value").alias("_mean")
    )
    return best.join(tone, F.lower("term") == F.col("_key"), "left").select(
        "rank", F.col("term").alias("keyword"), "score", F.coalesce("_tone", F.lit("neutral")).alias("sentiment"),
        F.coalesce("_mean", F.lit(0.0)).alias("avg_sentiment"),
    )


def sentiment_trend(facts: DataFrame) -> DataFrame:
    """Mean score and article count per week, in time order."""
    rows = _where(current(facts), "sentiment_trend")
    weeks = rows.groupBy(date_part(F.col("dimension_value")).alias("week")).agg(
        _value_if(F.col("metric") == "avg_sentiment").alias("avg_sentiment"),
        F.coalesce(_value_if(F.col("metric") == "article_count"), F.lit(0.0)).cast("bigint").alias("article_count"),
    )
    return weeks.filter(F.col("avg_sentiment").isNotNull()).orderBy("week")


def daily_volume(facts: DataFrame) -> DataFrame:
    rows = _where(current(facts), "volume_trends", "article_count")
    return rows.select(F.col("dimension_value").alias("date"), F.col("value").cast("bigint").alias("articles")).orderBy("date")


def entities(facts: DataFrame, top_n: int = 5) -> DataFrame:
    """The most mentioned names of each entity type."""
    rows = _where(current(facts), "named_entities").filter(F.col("dimension_value").isin(ENTITY_TYPES))
    order = Window.partitionBy("dimension_value").orderBy(F.desc("value"), "label")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n).select(
        F.col("dimension_value").alias("entity_type"), "rank", F.col("label").alias("name"),
        F.col("value").cast("bigint").alias("mentions"),
    )


def source_metrics(facts: DataFrame) -> DataFrame:
    """Sources as rows, their metrics as columns."""
    metrics = ["avg_sentiment", "avg_spoonacular_score", "avg_health_score", "record_count"]
    rows = _where(current(facts), "source_comparison")
    return rows.groupBy(F.col("dimension_value").alias("source")).pivot("metric", metrics).agg(F.first("value"))


def trending_recipes(facts: DataFrame, limit: int = 10) -> DataFrame:
    """Recipes by matched trend words, then by score."""
    rows = _where(current(facts), "recipe_trend_alignment")
    wide = rows.groupBy(F.col("dimension_value").alias("recipe_id")).agg(
        F.max(F.when(F.col("metric") == "trend_score", F.col("label"))).alias("title"),
        _value_if(F.col("metric") == "trend_score").alias("trend_score"),
        _value_if(F.col("metric") == "spoonacular_score").alias("score"),
        F.max(F.when(F.col("metric") == "matched_keywords", F.col("label"))).alias("matched"),
    )
    return wide.orderBy(F.desc("trend_score"), F.desc("score"), "recipe_id").limit(limit)


def narrative_summary(facts: DataFrame) -> DataFrame:
    """One row: top keyword, whole percent positive, recipe count, top diet flag and its label, and a sentence."""
    a, m, d = F.col("aggregation"), F.col("metric"), F.col("dimension_value")
    diets = (a == "dietary_breakdown") & (m == "count")

    def best(condition: Column, shown: str, tie: str) -> Column:
        # the highest value; of equal values the smallest name
        chosen = F.when(condition, F.struct((-F.col("value")).alias("v"), F.col(tie).alias("t"), F.col(shown).alias("shown")))
        return F.min(chosen)["shown"]

    one = current(facts).agg(
        best(a == "top_keywords", "label", "label").alias("top_keyword"),
        F.coalesce(
            _value_if((a == "sentiment_distribution") & (F.lower(d) == "positive") & (m == "percentage")), F.lit(0.0)
        ).cast("bigint").alias("pct_positive"),
        F.coalesce(
            _value_if((a == "source_comparison") & (d == "api_recipes") & (m == "record_count")), F.lit(0.0)
        ).cast("bigint").alias("recipe_count"),
        best(diets, "dimension_value", "dimension_value").alias("top_diet"),
        best(diets, "label", "dimension_value").alias("top_diet_label"),
    )
    sentence = F.format_string(
        "Talk of the week: %s; %d%% of the coverage is positive. Recipes to go with it: %d. Leading diet: %s.",
        F.coalesce("top_keyword", F.lit("—")), "pct_positive", "recipe_count", F.coalesce("top_diet_label", F.lit("—")),
    )
    return one.withColumn("narrative", sentence)
