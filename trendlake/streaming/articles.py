"""Article ingestion and weekly trends as streams over landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlake.functions.values import columns_of, half_up, parse_published
from trendlake.operators.dedupe import keep_first
from trendlake.plans.silver import clean_articles
from trendlake.sources import schemas


def stream_articles(spark: SparkSession, path: str, files_per_trigger: int = 1000, multi_line: bool = True) -> DataFrame:
    """Articles of the files that land below ``path``, with publication and extraction time (null if unreadable)."""
    reader = spark.readStream.schema(schemas.ARTICLE_FILE).option("multiLine", multi_line).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", files_per_trigger).json(path).withColumns({
        "published_at": parse_published(F.col("published_date")),
        "extracted_at": F.try_to_timestamp("date_extracted", F.lit("yyyyMMdd_HHmmss")),
    })


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def append_new(batch: DataFrame, stop_words: Sequence[str], table: str, key: str = "article_id") -> None:
    """Append the cleaned rows of ``batch`` whose key the table does not hold yet, one for each key.

    The table itself says which keys are known, so none is forgotten, however much later a
    copy lands, and a batch that is run again after a failure adds nothing. Its key column
    alone is read. Of copies in one batch the earliest extracted stays; a null key is a key
    like any other.
    """
    spark = batch.sparkSession
    others = [c for c in columns_of(batch, "scalar") if c not in (key, "extracted_at")]
    fresh = keep_first(batch.filter(F.col("extracted_at").isNotNull()), [key], ["extracted_at", *others])
    if _exists(spark, table):
        stored = spark.read.schema(f"`{key}` {batch.schema[key].dataType.simpleString()}").parquet(table).select(F.col(key).alias("_stored"))
        fresh = fresh.join(stored, F.col(key).eqNullSafe(F.col("_stored")), "left_anti")
    cleaned = clean_articles(fresh, stop_words).withColumn("dt", F.to_date("extracted_at"))
    cleaned.write.mode("append").partitionBy("dt").parquet(table)


def start_ingest(articles: DataFrame, stop_words: Sequence[str], table: str, checkpoint: str, key: str = "article_id") -> StreamingQuery:
    """Clean and append everything that is available and new to the table, then stop."""
    writer = articles.writeStream.foreachBatch(lambda batch, _: append_new(batch, stop_words, table, key))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_rejects(articles: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the rows without a readable extraction time, which the ingest cannot place, and stop."""
    writer = articles.filter(F.col("extracted_at").isNull()).writeStream.outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(table)


def weekly_windows(scored: DataFrame, time: str = "published_at", delay: str = "7 days") -> DataFrame:
    """Mean score and count per Monday week; the offset moves epoch weeks (Thursday) to Monday."""
    weeks = scored.withWatermark(time, delay).groupBy(F.window(time, "7 days", "7 days", "4 days"))
    return weeks.agg(half_up(F.avg("compound_score"), 4).alias("avg_sentiment"), F.count("*").alias("article_count")).select(
        F.to_date("window.start").alias("week"), "avg_sentiment", "article_count"
    )
