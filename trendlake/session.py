"""Session settings the library expects."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "trendlake", **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def written_once(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written to ``folder`` (the shared one) and read back.

    For a table that several aggregations of one job read: it is computed once, read
    by column, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/trendlake/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own in the shared one for a job's intermediate tables, deleted at the job's end."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4()}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
