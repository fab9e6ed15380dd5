"""The daily run: landed files to published fact tables, in one application.

Layout below ``base``: ``bronze/{articles,recipes}``, ``silver/{articles,recipes,rejects}``,
``gold/{gold_articles,gold_recipes,governance,storytelling}``, each with ``dt=`` partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.constants import ANCHOR_SEEDS, RETENTION_DAYS, TARGET_INGREDIENTS, TOPIC_VOCABULARY
from trendlake.functions.text import slug
from trendlake.operators.keywords import trending_keywords
from trendlake.operators.search import as_list, search_by_keywords
from trendlake.operators.sentiment import add_sentiment
from trendlake.plans.gold import gold_articles, gold_recipes
from trendlake.plans.governance import governance_facts
from trendlake.plans.silver import silver_articles, silver_recipes
from trendlake.plans.storytelling import TEXT, storytelling_facts
from trendlake.session import work_folder
from trendlake.sources import landed, partitions, sinks
from trendlake.sources.drift import read_reconciled, union_all

GOLD_TABLES = ["gold_articles", "gold_recipes", "governance", "storytelling"]


@dataclass
class Inputs:
    """Tables a run needs besides the landed files."""

    lexicon: DataFrame
    stop_words: Sequence[str]
    vocabulary: Sequence[str] = field(default_factory=lambda: list(TOPIC_VOCABULARY))
    vectors: DataFrame | None = None
    seeds: Sequence[str] = field(default_factory=lambda: list(ANCHOR_SEEDS))
    gazetteer: DataFrame | None = None
    catalogue: DataFrame | None = None


def _table(spark: SparkSession, path: str, day: date) -> DataFrame:
    """The day's partition of a Parquet table whose files may have drifted."""
    files = partitions.file_listing(spark, partitions.partition_path(spark, path, day), "*.parquet").select("path")
    return read_reconciled(spark, [r.path for r in files.collect()])


def land_keyword_hits(keywords: DataFrame, catalogue: DataFrame, path: str, day: date, number: int = 5) -> None:
    """Recipes found for each keyword, landed as one ``results`` file per keyword."""
    hits = search_by_keywords(keywords, catalogue, ["title"], number)
    recipe = F.struct(*[F.col(c) for c in catalogue.columns])
    payload = hits.groupBy("query").agg(F.collect_list(recipe).alias("results"))
    files = payload.select(
        "results", F.size("results").alias("totalResults"), slug(F.col("query")).alias("query")
    ).withColumn("dt", F.lit(day).cast("date"))
    writer = files.write.partitionBy("dt", "query").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", 1).json(path)


def run_daily(
    spark: SparkSession, base: str, inputs: Inputs, run_ts: datetime, target: str | None = None,
    retention_days: int = RETENTION_DAYS,
) -> dict[str, int]:
    """Run every step for the day of ``run_ts``; returns rows written per table.

    A run reads what had landed up to its day and the partitions it has written itself,
    so a day can be run again, also after later ones. Intermediate tables are deleted at
    the end.
    """
    with work_folder(spark) as folder:
        return _run(spark, base, inputs, run_ts, target, retention_days, folder)


def _run(
    spark: SparkSession, base: str, inputs: Inputs, run_ts: datetime, target: str | None, retention_days: int, folder: str
) -> dict[str, int]:
    day = run_ts.date()
    bronze, silver, gold = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    written: dict[str, int] = {}

    articles = landed.read_articles(spark, partitions.partition_path(spark, f"{bronze}/articles", day))
    written["silver_articles"] = sinks.write_dated(
        silver_articles(articles, inputs.stop_words), f"{silver}/articles", day
    )
    if inputs.catalogue is not None:
        cleaned = _table(spark, f"{silver}/articles", day)
        columns = ["article_summary_clean", "article_title_clean"]
        keywords = trending_keywords(cleaned, columns, 10, inputs.vocabulary, inputs.vectors, inputs.seeds)
        land_keyword_hits(keywords, inputs.catalogue, f"{bronze}/recipes", day)

    recipes = landed.read_recipes(spark, partitions.partition_path(spark, f"{bronze}/recipes", day))
    recipe_fields = landed.field_names(spark, partitions.partition_path(spark, f"{bronze}/recipes", day), "results")
    article_fields = landed.field_names(spark, partitions.partition_path(spark, f"{bronze}/articles", day))
    written["silver_recipes"] = sinks.write_dated(silver_recipes(recipes), f"{silver}/recipes", day)

    cleaned_articles, cleaned_recipes = (_table(spark, f"{silver}/{t}", day) for t in ("articles", "recipes"))
    written["gold_recipes"] = sinks.write_dated(gold_recipes(cleaned_recipes), f"{gold}/gold_recipes", day)
    written["gold_articles"] = sinks.write_dated(gold_articles(cleaned_articles), f"{gold}/gold_articles", day)

    lost = [
        landed.rejected(landed.read_recipe_files(spark, partitions.partition_path(spark, f"{bronze}/recipes", day)), "api", "results"),
        landed.rejected(landed.read_article_files(spark, partitions.partition_path(spark, f"{bronze}/articles", day)), "webscraping"),
    ]
    written["rejects"] = sinks.write_dated(union_all(lost), f"{silver}/rejects", day)
    rejects = spark.read.schema(landed.REJECTS).parquet(partitions.partition_path(spark, f"{silver}/rejects", day))

    sources = {"api": "recipes", "webscraping": "articles"}
    targets = spark.createDataFrame([(t,) for t in TARGET_INGREDIENTS], "ingredient string")
    found = cleaned_recipes.select(F.explode(as_list(cleaned_recipes, "ingredient_names")).alias("ingredient"))
    governance = governance_facts(
        cleaned_recipes, cleaned_articles, run_ts,
        partitions.source_listing(spark, {s: f"{silver}/{t}" for s, t in sources.items()}, "*.parquet"),
        partitions.source_listing(spark, {s: f"{bronze}/{t}" for s, t in sources.items()}, "*.json"),
        targets, found,
        landed.columns_seen(cleaned_recipes.columns, recipes.columns, recipe_fields),
        landed.columns_seen(cleaned_articles.columns, articles.columns, article_fields),
        rejects=rejects,
    )
    written["governance"] = sinks.write_dated(governance, f"{gold}/governance", day, small=True)

    curated = _table(spark, f"{gold}/gold_articles", day)
    scored = add_sentiment(curated, TEXT, inputs.lexicon)
    story = storytelling_facts(
        scored, _table(spark, f"{gold}/gold_recipes", day), run_ts,
        inputs.vocabulary, inputs.vectors, inputs.seeds, inputs.gazetteer, folder,
    )
    written["storytelling"] = sinks.write_dated(story, f"{gold}/storytelling", day)

    if target is not None:
        sinks.publish_latest(spark, gold, target, GOLD_TABLES)
        sinks.publish_snapshot(spark, {t: spark.read.parquet(partitions.partition_path(spark, f"{gold}/{t}", day)) for t in GOLD_TABLES}, f"{target}/snapshots")
    layers = [f"{bronze}/articles", f"{bronze}/recipes", f"{silver}/articles", f"{silver}/recipes", f"{silver}/rejects"]
    partitions.apply_retention(spark, layers + [f"{gold}/{t}" for t in GOLD_TABLES], day, retention_days)
    return written
