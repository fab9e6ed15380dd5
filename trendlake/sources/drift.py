"""Parquet scans over files whose schemas drifted apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KNOWN_CONFLICTS = {"license": "string"}


def _merged_schema(spark: SparkSession, files: Sequence[str]) -> T.StructType | None:
    """Schema of all files together, read in parallel from the footers; None on a type conflict."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if len(files) > 1 and "CANNOT_MERGE" in str(error):
            return None
        raise


def _compatible(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name: f.dataType for f in a.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in b.fields)


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[list[str]]:
    """Files grouped so that each group merges without conflict.

    Halving on conflict finds the few schemas without one read per file.
    """
    groups: list[tuple[T.StructType, list[str]]] = []
    pending = [list(files)]
    while pending:
        batch = pending.pop(0)
        schema = _merged_schema(spark, batch)
        if schema is None:
            middle = len(batch) // 2
            pending[:0] = [batch[:middle], batch[middle:]]
            continue
        for i, (known, members) in enumerate(groups):
            if _compatible(known, schema):
                extra = [f for f in schema.fields if f.name not in known.names]
                groups[i] = (T.StructType(known.fields + extra), members + batch)
                break
        else:
            groups.append((schema, batch))
    return [members for _, members in groups]


def read_reconciled(
    spark: SparkSession, files: Sequence[str], casts: Mapping[str, str] = KNOWN_CONFLICTS
) -> DataFrame:
    """All files as one table: conflicting columns cast first, absent columns null.

    The plan has one branch per schema, not per file.
    """
    if not files:
        raise FileNotFoundError("no Parquet files to read")
    branches = []
    for members in schema_groups(spark, sorted(files)):
        branch = spark.read.option("mergeSchema", True).parquet(*members)
        present = {c: F.col(c).cast(t) for c, t in casts.items() if c in branch.columns}
        branches.append(branch.withColumns(present) if present else branch)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
