"""Quantile sketches: one pass, storable for each partition, merged without reading rows again.

A sketch of ``SIZE`` holds about three times as many values, whatever the number of rows. A
quantile that it gives lies within ``RANK_ERROR`` of its rank with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions.values import without_nan

SIZE = 400
RANK_ERROR = 0.01


def sketch_of(value: Column) -> Column:
    """Aggregate: the sketch of the values that are not null."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(SIZE))


def quantile_of(sketch: Column, p: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(p))


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """(the columns of ``by``, field, n, sketch): a row for each group and column that has values."""
    df = without_nan(df, list(columns))
    grouped = df.groupBy(*by).agg(*[F.struct(F.lit(c).alias("field"), F.count(c).alias("n"), sketch_of(F.col(c)).alias("sketch")).alias(f"_s{i}") for i, c in enumerate(columns)])
    names = grouped.columns[: len(by)]
    return grouped.select(*names, F.inline(F.array(*[f"_s{i}" for i in range(len(columns))]))).filter("n > 0")


def merged(sketches: DataFrame, by: Sequence[str] = ("field",)) -> DataFrame:
    """The sketches of each group as one, as if its rows had been sketched together."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SIZE)).alias("sketch"))
