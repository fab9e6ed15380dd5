"""Entity mentions counted against a gazetteer table (``name``, ``entity_type``)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.functions.text import normalise
from trendlake.operators.longform import long_rows, story_row


def entity_text(title: str, summary: str, max_chars: int | None = None):
    """Title and summary as one text; ``max_chars`` shortens the summary."""
    body = F.coalesce(F.col(summary), F.lit(""))
    if max_chars is not None:
        body = F.substring(body, 1, max_chars)
    return F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(". "), body)


def entity_counts(df: DataFrame, text: str, gazetteer: DataFrame, min_chars: int = 3) -> DataFrame:
    """``entity_type``, ``name``, ``mentions`` of whole-word phrase matches, ignoring case.

    Only places whose word opens a name become phrases, and phrases are counted before
    they meet the gazetteer, so a frequent phrase is one row by then. Spark chooses how
    to join by the gazetteer's size.
    """
    names = gazetteer.filter(F.length(F.trim("name")) >= min_chars).select(
        F.trim("name").alias("name"), "entity_type", normalise(F.col("name")).alias("phrase")
    ).distinct()
    parts = names.select(F.split("phrase", " ").alias("p")).select(F.size("p").alias("words"), F.get("p", 0).alias("first"))
    lengths = [r["words"] for r in parts.select("words").distinct().orderBy("words").collect()]
    if not lengths:
        return df.sparkSession.createDataFrame([], "entity_type string, name string, mentions bigint")
    openers = parts.select(F.col("first").alias("w0")).distinct()

    words = df.select(F.split(normalise(F.col(text)), " ").alias("w"))
    shifted = [F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{i}") for i in range(max(lengths))]
    places = words.select(F.inline(F.arrays_zip(*shifted)))
    phrases = [
        F.when(F.col(f"w{n - 1}").isNotNull(), F.concat_ws(" ", *[f"w{i}" for i in range(n)])) for n in lengths
    ]
    found = F.explode(F.array_compact(F.array(*phrases))).alias("phrase")
    phrases_found = places.join(openers, "w0", "left_semi").select(found).groupBy("phrase").agg(F.count("*").alias("n"))
    matched = phrases_found.join(names, "phrase")
    return matched.groupBy("entity_type", "name").agg(F.sum("n").alias("mentions"))


def top_entities(counts: DataFrame, top_n: int, types: Sequence[str] | None = None) -> DataFrame:
    """The ``top_n`` names of each type with their ``rank``."""
    if types is not None:
        counts = counts.filter(F.col("entity_type").isin(list(types)))
    order = Window.partitionBy("entity_type").orderBy(F.desc("mentions"), "name")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)


def named_entities(df: DataFrame, text: str, gazetteer: DataFrame, run_ts: datetime, top_n: int = 8) -> DataFrame:
    best = top_entities(entity_counts(df, text, gazetteer), top_n)
    row = story_row(
        "named_entities", "entities", "entity_type", F.col("entity_type"), "count", F.col("mentions"), F.col("name")
    )
    return long_rows(best, [row], run_ts)
