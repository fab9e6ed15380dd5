"""Date partitions: listing, newest one, inventory, retention.

Directory names (``dt=2026-05-27`` or ``2026-05-27``) come from one listing call;
table files are not opened for them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.constants import RETENTION_DAYS
from trendlake.functions.values import date_from_name

_DATE_DIRECTORY = re.compile(r"^(?:dt=)?(\d{4}-\d{2}-\d{2})$")
LISTING_SCHEMA = "base string, name string, path string"


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _directories(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """(date text, path) of the date directories, oldest first; none if the base is absent."""
    system, path = file_system(spark, base)
    if not system.exists(path):
        return []
    found = []
    for status in system.listStatus(path):
        match = _DATE_DIRECTORY.match(status.getPath().getName())
        if status.isDirectory() and match:
            found.append((match.group(1), status.getPath().toString()))
    return sorted(found)


def partition_listing(spark: SparkSession, bases: Sequence[str]) -> DataFrame:
    """``base``, ``name`` (date text) and ``path`` of every date partition."""
    rows = [(base, name, path) for base in bases for name, path in _directories(spark, base)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def latest_partition_path(spark: SparkSession, base: str, required: bool = False) -> str:
    """Newest date directory; without any the base itself, or an error when ``required``."""
    found = _directories(spark, base)
    if not found:
        if required:
            raise FileNotFoundError(f"no date partitions under {base}")
        return base
    return found[-1][1]


def partition_path(spark: SparkSession, base: str, day: date) -> str:
    """Newest date directory up to ``day``; later ones belong to later runs. Without any the base itself."""
    found = [path for name, path in _directories(spark, base) if name <= day.isoformat()]
    return found[-1] if found else base


def latest_partition_date(spark: SparkSession, base: str) -> str | None:
    found = _directories(spark, base)
    return found[-1][0] if found else None


def newest(df: DataFrame, column: str | Column) -> DataFrame:
    """Rows that hold the highest value of a date or run-time column."""
    value = F.col(column) if isinstance(column, str) else column
    return df.filter(value == df.agg(F.max(value)).scalar())


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """Every Parquet file below ``base``, schemas merged."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(base)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def file_listing(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """``path``, ``modified``, ``name`` and partition ``dt`` of the files below ``base``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = reader.load(base).select("path", F.col("modificationTime").alias("modified"))
    return files.withColumns({
        "name": F.regexp_extract("path", "[^/]+$", 0),
        "dt": date_from_name(F.regexp_extract("path", r"/(?:dt=)?(\d{4}-\d{2}-\d{2})/", 1)),
    })


def source_listing(spark: SparkSession, bases: dict[str, str], pattern: str = "*") -> DataFrame:
    """File listings of several sources with their ``source`` name; absent sources give no rows."""
    schema = "path string, modified timestamp, name string, dt date, source string"
    listing = spark.createDataFrame([], schema)
    for source, base in bases.items():
        system, path = file_system(spark, base)
        if system.exists(path):
            listing = listing.unionByName(file_listing(spark, base, pattern).withColumn("source", F.lit(source)))
    return listing


def newest_of_each(files: DataFrame, source: str = "source") -> DataFrame:
    """The files of the newest partition of each source; a source without dated files gives none.

    The newest dates are an aggregate, so a source with most of the files is one row a task.
    """
    days = files.groupBy(F.col(source).alias("_source")).agg(F.max("dt").alias("_dt"))
    return files.join(days, F.col(source).eqNullSafe(F.col("_source")) & (F.col("dt") == F.col("_dt"))).select(*files.columns)


def distinct_paths(files: DataFrame) -> DataFrame:
    return files.select("path").distinct()


def latest_file(files: DataFrame, by: str = "modified") -> DataFrame:
    """The newest file of a listing, by modification time or by name."""
    return files.orderBy(F.desc(by), F.desc("path")).limit(1)


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table``, ``rows`` and ``files`` of scanned tables; no column is read. Tables and files without rows count as well."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(len(df.inputFiles())).cast("long").alias("files")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def freshness(files: DataFrame) -> DataFrame:
    """One row: newest partition date and time of the last write."""
    return files.agg(
        F.max("dt").alias("partition_date"), F.date_format(F.max("modified"), "yyyy-MM-dd HH:mm:ss").alias("updated_at")
    )


def inventory(files: DataFrame) -> DataFrame:
    """Per source: distinct dates, files in total and files in its newest partition."""
    per_day = files.groupBy("source", "dt").agg(F.count("*").alias("n"))
    return per_day.groupBy("source").agg(
        F.count("dt").alias("distinct_dates"), F.sum("n").alias("files"), F.max_by("n", "dt").alias("latest_files"),
        F.max("dt").alias("latest_date"), F.array_sort(F.collect_set(F.col("dt").cast("string"))).alias("dates"),
    )


def retention_plan(partitions: DataFrame, today: date, retention_days: int = RETENTION_DAYS) -> DataFrame:
    """Each dated partition with ``status`` deleted or kept; names that are no date are left alone."""
    dated = partitions.withColumn("dt", date_from_name(F.col("name"))).filter(F.col("dt").isNotNull())
    cutoff = F.date_sub(F.lit(today), retention_days)
    return dated.withColumn("status", F.when(F.col("dt") < cutoff, "deleted").otherwise("kept"))


def apply_retention(
    spark: SparkSession, bases: Sequence[str], today: date, retention_days: int = RETENTION_DAYS, dry_run: bool = False
) -> DataFrame:
    """Drop the partitions older than the window; ``path``, ``dt``, ``status`` and ``error`` per partition."""
    outcome = []
    plan = retention_plan(partition_listing(spark, bases), today, retention_days)
    for row in plan.select("path", "dt", "status").orderBy("path").collect():
        error = None
        if row.status == "deleted" and not dry_run:
            try:
                system, path = file_system(spark, row.path)
                if not system.delete(path, True):
                    error = "not deleted"
            except Py4JJavaError as problem:
                error = str(problem.java_exception)
        outcome.append((row.path, row.dt, "error" if error else row.status, error))
    return spark.createDataFrame(outcome, "path string, dt date, status string, error string")
