"""The two long fact schemas and the step from wide aggregates to long rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOVERNANCE_SCHEMA = (
    "kpi_name string, category string, source string, field string, "
    "value double, unit string, finding string, computed_at timestamp"
)
STORYTELLING_SCHEMA = (
    "aggregation string, category string, dimension_name string, dimension_value string, "
    "metric string, value double, label string, computed_at timestamp"
)


def _text(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("string")


def _number(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("double")


def kpi_row(kpi: str, category: str, source: str, field, value, unit: str, finding) -> Column:
    """One governance row as a struct."""
    return F.struct(
        F.lit(kpi).alias("kpi_name"), F.lit(category).alias("category"), _text(source).alias("source"),
        _text(field).alias("field"), _number(value).alias("value"), F.lit(unit).alias("unit"),
        _text(finding).alias("finding"),
    )


def story_row(aggregation: str, category: str, dimension: str, dimension_value, metric: str, value, label) -> Column:
    """One storytelling row as a struct."""
    return F.struct(
        F.lit(aggregation).alias("aggregation"), F.lit(category).alias("category"),
        _text(dimension).alias("dimension_name"), _text(dimension_value).alias("dimension_value"),
        F.lit(metric).alias("metric"), _number(value).alias("value"), _text(label).alias("label"),
    )


def long_rows(wide: DataFrame, rows: Sequence[Column], run_ts: datetime, lists: Sequence[Column] = ()) -> DataFrame:
    """Each wide row becomes its long rows, single ones and whole arrays of them; null structs give no row."""
    every = [*([F.array(*rows)] if rows else []), *lists]
    packed = F.filter(F.concat(*every) if len(every) > 1 else every[0], lambda r: r.isNotNull())
    return wide.select(F.inline(packed)).withColumn("computed_at", F.lit(run_ts).cast("timestamp"))
