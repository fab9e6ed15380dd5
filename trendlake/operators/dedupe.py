"""Duplicate removal and duplicate rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.values import columns_of, percent
from trendlake.operators.longform import kpi_row, long_rows


def _compact(field: T.StructField) -> Column:
    """Long text shrinks to a digest, so whole documents are neither compared nor shuffled as keys."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.when(F.length(column) > 64, F.concat(F.lit("#"), F.sha2(column, 256))).otherwise(column)
    return column


def key_columns(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [_compact(df.schema[name]).alias(f"_key{i}") for i, name in enumerate(names)]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the smallest by ``order``; a null key is a key like any other.

    An aggregate, not a window: copies of a hot key are reduced before the shuffle.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*key_columns(df, keys)).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def key_duplicates(df: DataFrame, key: str) -> DataFrame:
    """One row: ``total`` rows and ``duplicates`` beyond the first of each key."""
    per_key = df.groupBy(*key_columns(df, [key])).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )


def duplicate_row(key: str, source: str) -> Column:
    """The KPI row of ``total`` and ``duplicates``."""
    finding = F.format_string("%d of %d rows repeat a value of %s", "duplicates", "total", F.lit(key))
    rate = F.coalesce(percent(F.col("duplicates"), F.col("total")), F.lit(0.0))
    return kpi_row("duplicate_rate", "uniqueness", source, key, rate, "%", finding)


def duplicate_rate(df: DataFrame, key: str, source: str, run_ts: datetime) -> DataFrame:
    return long_rows(key_duplicates(df, key), [duplicate_row(key, source)], run_ts)


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows, full-row copies beyond the first over the scalar columns, and their rate."""
    scalar = set(columns_of(df, "scalar"))
    keys = [_compact(f).alias(f.name) for f in df.schema.fields if f.name in scalar]
    per_row = df.select(*keys).groupBy(*scalar).agg(F.count("*").alias("_n"))
    counted = per_row.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )
    return counted.withColumn("rate", F.coalesce(percent(F.col("duplicates"), F.col("total")), F.lit(0.0)))
