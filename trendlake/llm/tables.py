"""Written intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """Tables and files of one operator run, each under its own fresh folder.

    A written table is computed once, is read back by column, and survives lost
    executors. Tables that the result no longer needs are dropped by name; what a lazy
    result still reads stays until its owner clears the shared folder.
    """

    def __init__(self, spark: SparkSession, operator: str, run: str | None = None):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{operator}-{run or uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write_file(self, name: str, content: bytes) -> str:
        """One bounded file through Spark's own file systems, so that any shared store will do."""
        path, system = self._files(name)
        stream = system.create(path, True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        return self.path(name)

    def drop(self, *names: str) -> None:
        for name in names:
            path, system = self._files(name)
            system.delete(path, True)
