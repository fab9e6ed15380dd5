"""Landed JSON and XML files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlake.constants import FEED_ITEM_CAP, LOCATION_FOCUS
from trendlake.functions.text import strip_tags_simple
from trendlake.functions.values import default_text
from trendlake.sources import schemas

SOURCE_FILE = "_source_file"
POSITION = "_position"
CORRUPT = "_corrupt"
REJECTS = "source string, source_file string, reason string, chars int, digest string"


def _json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Landed JSON files by a declared schema; what does not fit it is kept as text in ``CORRUPT``."""
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT)
    files = reader.option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return files.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def parsed(payloads: DataFrame, text: str, schema: str) -> DataFrame:
    """Payload texts parsed like landed files: the fields of ``schema``, ``CORRUPT``, and the other columns."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in payloads.columns if c != text]
    return payloads.select(F.from_json(text, f"{schema}, {CORRUPT} string", options).alias("_parsed"), *others).select("_parsed.*", *others)


def _unread(payloads: DataFrame) -> Column:
    """Whether nothing of a payload could be read."""
    fields = [c for c in payloads.columns if c not in (CORRUPT, SOURCE_FILE, POSITION)]
    return F.col(CORRUPT).isNotNull() & F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in fields]).isNull()


def accepted(payloads: DataFrame) -> DataFrame:
    """The payloads of which something could be read."""
    return payloads.filter(~_unread(payloads)).drop(CORRUPT)


def rejected(payloads: DataFrame, source: str, needed: str | None = None) -> DataFrame:
    """The reject table of payloads: ``REJECTS``, a row for each that lost something.

    ``unreadable`` ones give no rows at all; of ``partly read`` ones, in which a value has
    another type than declared or the text ends early, what could be read is used;
    ``incomplete`` ones are well formed but lack the field ``needed``. The text itself is not
    copied: its file, length and digest identify it.
    """
    lacking = F.lit(False) if needed is None else F.col(needed).isNull()
    reason = F.when(_unread(payloads), "unreadable").when(F.col(CORRUPT).isNotNull(), "partly read").when(lacking, "incomplete")
    rows = payloads.select(F.lit(source).alias("source"), F.col(SOURCE_FILE).alias("source_file"), reason.alias("reason"),
                           F.length(CORRUPT).alias("chars"), F.sha2(CORRUPT, 256).alias("digest"))
    return rows.filter("reason IS NOT NULL")


def read_recipe_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed payload, readable or not, with its file."""
    return _json(spark, path, schemas.RECIPE_FILE).select("results", CORRUPT, SOURCE_FILE)


def read_recipes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per recipe of the ``results`` arrays; files with empty results and unreadable ones give no rows."""
    return recipe_rows(accepted(read_recipe_files(spark, path)))


def recipe_rows(payloads: DataFrame) -> DataFrame:
    """One row per recipe of parsed payloads (``results`` and the source file)."""
    return payloads.selectExpr("inline(results)", SOURCE_FILE)


def read_article_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per article, and one per unreadable file, with its file and its position there."""
    return _json(spark, path, schemas.ARTICLE_FILE).withColumn(POSITION, F.monotonically_increasing_id())


def read_articles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per article of the JSON arrays, with its file and its position there; unreadable files give none."""
    return accepted(read_article_files(spark, path))


def field_names(spark: SparkSession, path: str | list[str], within: str | None = None) -> set[str]:
    """Distinct field names of the objects in landed JSON files, or in the array ``within`` each; malformed files have none."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    body = F.trim(F.regexp_replace("value", r"^\s+", "")) if within is None else F.get_json_object("value", f"$.{within}")
    listed = F.from_json(F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body), "array<string>")
    keys = files.select(F.explode(listed).alias("item")).select(F.explode(F.json_object_keys("item")).alias("name"))
    return {row["name"] for row in keys.distinct().collect()}  # names, not rows


def columns_seen(stored: list[str], declared: list[str], fields: set[str]) -> list[str] | None:
    """``stored`` without declared columns that no payload has, and the payloads' undeclared fields; None if nothing landed."""
    return [c for c in stored if c not in declared or c in fields] + sorted(fields - set(declared)) if fields else None


def _feed(spark: SparkSession, path: str | list[str], tag: str, schema: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    return rows.withColumns({
        SOURCE_FILE: F.col("_metadata.file_path"),
        POSITION: F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")),
    })


def _article(source: str, extracted: Column, **columns: Column) -> list[Column]:
    constants = {"source": F.lit(source), "location_focus": F.lit(LOCATION_FOCUS), "date_extracted": extracted}
    values = {**columns, **constants}
    order = [part.split(" ")[0] for part in schemas.ARTICLE_FILE.split(", ")]
    return [values[name].alias(name) for name in order] + [F.col(SOURCE_FILE), F.col(POSITION)]


def _first_filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values], F.lit(""))


def read_rss(spark: SparkSession, path: str | list[str], source: str, extracted: Column) -> DataFrame:
    """RSS items as article rows."""
    return rss_articles(_feed(spark, path, "item", schemas.RSS_ITEM), source, extracted)


def rss_articles(items: DataFrame, source: str, extracted: Column) -> DataFrame:
    """Article rows of parsed items, with their file and position."""
    categories = F.coalesce(F.col("category"), F.array().cast("array<string>"))
    return items.select(*_article(
        source, extracted,
        article_title=default_text(F.col("title"), "Untitled"),
        article_url=default_text(F.col("link")),
        article_id=default_text(F.col("guid")),
        author=default_text(F.col("`dc:creator`")),
        published_date=default_text(F.col("pubDate")),
        article_summary=strip_tags_simple(_first_filled(F.col("`content:encoded`"), F.col("description"))),
        categories=F.transform(F.filter(categories, lambda c: c.isNotNull() & (c != "")), lambda c: F.trim(c)),
    ))


def read_atom(spark: SparkSession, path: str | list[str], source: str, extracted: Column) -> DataFrame:
    """Atom entries as article rows; the first link without a relation or with ``alternate`` counts."""
    return atom_articles(_feed(spark, path, "entry", schemas.ATOM_ENTRY), source, extracted)


def atom_articles(entries: DataFrame, source: str, extracted: Column) -> DataFrame:
    """Article rows of parsed entries, with their file and position."""
    own = F.filter("link", lambda l: F.coalesce(l["_rel"], F.lit("")).isin("", "alternate"))
    terms = F.transform(F.coalesce(F.col("category"), F.array().cast("array<struct<_term: string>>")), lambda c: c["_term"])
    return entries.select(*_article(
        source, extracted,
        article_title=default_text(F.col("title"), "Untitled"),
        article_url=F.coalesce(F.get(own, 0)["_href"], F.lit("")),
        article_id=default_text(F.col("id")),
        author=default_text(F.col("author.name")),
        published_date=_first_filled(F.col("published"), F.col("updated")),
        article_summary=strip_tags_simple(_first_filled(F.col("content"), F.col("summary"))),
        categories=F.transform(F.filter(terms, lambda t: t.isNotNull() & (t != "")), lambda t: F.trim(t)),
    ))


def cap_per_feed(articles: DataFrame, cap: int = FEED_ITEM_CAP) -> DataFrame:
    """The first ``cap`` articles of each feed file in document order."""
    order = Window.partitionBy(SOURCE_FILE).orderBy(POSITION)
    return articles.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= cap).drop("_n")
