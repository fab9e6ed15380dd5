"""The given tables under the names of the library's data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import parameters as q
from trendlake.operators.sentiment import add_sentiment
from trendlake.plans.gold import gold_articles
from trendlake.plans.governance import governance_facts
from trendlake.plans.silver import clean_articles
from trendlake.plans.storytelling import storytelling_facts
from trendlake.session import written_once

TEXT = "article_summary_clean"


class Tables:
    """Lazy views over one directory of the given Parquet files."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def scan(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return self.scan(name)

    def raw_articles(self) -> DataFrame:
        """``documents`` as articles; the first line is the title, source and language are categories."""
        return self["documents"].select(
            F.col("doc_id").alias("article_id"),
            F.regexp_extract("text", r"^[^.\n]*", 0).alias("article_title"),
            F.col("text").alias("article_summary"),
            F.concat_ws(",", "source", "lang").alias("categories"),
            "source", F.col("lang").alias("author"),
        )

    def articles(self) -> DataFrame:
        return clean_articles(self.raw_articles(), q.STOP_WORDS)

    def stored_articles(self) -> DataFrame:
        """Cleaned articles as a written table, for queries that read the corpus more than once."""
        return written_once(self.articles().select("article_id", TEXT, "article_title_clean"))

    def stored_scored(self) -> DataFrame:
        """Scored articles as a written table."""
        return written_once(self.scored().select("article_id", TEXT, "compound_score", "sentiment_label"))

    def dated_articles(self) -> DataFrame:
        """Articles with the time of the event of the same number as a feed date."""
        text = F.date_format("ts", "dd MMM yyyy HH:mm:ss")
        dates = self["events"].select(
            F.col("event_id").alias("article_id"), F.concat(F.lit("Mon, "), text, F.lit(" +0000")).alias("published_date")
        )
        return self.articles().join(dates, "article_id", "left")

    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(list(q.LEXICON.items()), "token string, valence double")

    def gazetteer(self) -> DataFrame:
        return self.spark.createDataFrame(q.GAZETTEER, "name string, entity_type string")

    def scored(self, dated: bool = False) -> DataFrame:
        articles = self.dated_articles() if dated else self.articles()
        return add_sentiment(articles, TEXT, self.lexicon(), boosters=q.BOOSTERS, negations=q.NEGATIONS)

    def recipes(self) -> DataFrame:
        """``part`` as recipes: words of the name are ingredients, size and price give flags and scores."""
        size = F.col("p_size")
        return self["part"].select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("cuisines"),
            F.col("p_brand").alias("dishTypes"), F.col("p_retailprice").alias("spoonacularScore"),
            (size * 2.0).alias("healthScore"), (size % 17).alias("aggregateLikes"), size.alias("readyInMinutes"),
            F.when(size > 5, size <= 20).alias("vegetarian"), (size <= 10).alias("vegan"),
            (size % 3 == 0).alias("glutenFree"), (size % 4 == 0).alias("dairyFree"), (size > 45).alias("veryHealthy"),
            F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")).alias("ingredient_names"),
            F.concat_ws(
                ", ", F.when(size <= 10, "vegan"), F.when(size % 3 == 0, "gluten free"), F.when(size % 4 == 0, "dairy free")
            ).alias("diets"),
        )

    def event_files(self) -> DataFrame:
        """Events as a listing of landed files: their type is the source."""
        return self["events"].select(F.col("event_type").alias("source"), F.to_date("ts").alias("dt"))

    def governance_job(self) -> DataFrame:
        """The complete governance job: cleaned articles with the partly missing labels, recipes, listings and targets."""
        labels = self["labels"].withColumnRenamed("doc_id", "article_id")
        return governance_facts(
            self.recipes().withColumn("summary", F.concat_ws(" – ", "title", "cuisines")),
            self.articles().join(labels, "article_id", "left"), q.RUN_TS,
            silver_files=self["orders"].select(F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("dt")),
            bronze_files=self.event_files(), targets=self.spark.createDataFrame([(n,) for n in q.TARGETS], "name string"),
            found_targets=self["supplier"].join(self["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name")),
            outlier_method="discrete",
        )

    def governance(self) -> DataFrame:
        """Governance facts, stored as the job does."""
        return written_once(self.governance_job())

    def story(self) -> DataFrame:
        """Storytelling facts of articles and recipes, stored as the job does."""
        facts = storytelling_facts(
            self.scored(dated=True), self.recipes(), q.RUN_TS, q.VOCABULARY, gazetteer=self.gazetteer()
        )
        return written_once(facts)

    def curated(self) -> DataFrame:
        return gold_articles(self.articles())
