"""Scalar rules shared by the operators: rounding, labels, coercions, dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.constants import NEGATIVE_UP_TO, POSITIVE_FROM


def half_up(value: Column, digits: int) -> Column:
    """Round half up on the double itself (same formula in any SQL engine).

    NaN and infinities stay; so does a number too large to have a fraction.
    """
    scale = float(10**digits)
    number = value.cast("double")
    rounded = F.floor(number * scale + 0.5) / F.lit(scale)
    return F.when(F.abs(number) * scale < 2.0**52, rounded).otherwise(number)


def without_nan(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` with NaN as null in the floating-point columns among ``columns``."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))} & set(columns)
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in df.columns if c in floating})


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` rounded; null when ``whole`` is zero."""
    return half_up(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= POSITIVE_FROM, "positive")
        .when(score <= NEGATIVE_UP_TO, "negative")
        .otherwise("neutral")
    )


def positive_or_not(score: Column) -> Column:
    return F.when(score >= POSITIVE_FROM, "positive").otherwise("neutral/negative")


def severity(value: Column, high: float = 80.0, medium: float = 20.0) -> Column:
    return F.when(value > high, "high").when(value > medium, "medium").otherwise("low")


def to_int(value: Column) -> Column:
    """Whole number or null; text that is no number becomes null."""
    plain = value.cast("string").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    number = F.when(plain, value.try_cast("double"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def default_text(value: Column, default: str = "") -> Column:
    return F.coalesce(F.trim(value), F.lit(default))


def parse_published(value: Column) -> Column:
    """Feed dates (``Tue, 26 May 2026 10:11:12 +0000``, ``... GMT``, ISO) to timestamp.

    The day name is dropped first: the default parser has no pattern letter for it.
    """
    bare = F.regexp_replace(F.trim(value), r"^\p{L}{3}, *", "")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss zzz")),
        F.try_to_timestamp(bare),
    )


def published_date(value: Column) -> Column:
    return F.to_date(parse_published(value))


def date_part(value: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp or of a timestamp written as text."""
    return F.substring(value.cast("string"), 1, 10)


def is_date_name(value: Column) -> Column:
    return value.rlike(r"^\d{4}-\d{2}-\d{2}$")


def date_from_name(value: Column) -> Column:
    return F.when(is_date_name(value), value.try_cast("date"))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def has_text(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def present_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Allow-list projection that tolerates absent columns."""
    return df.select(*present_columns(df, wanted))


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Column names by type family: ``string``, ``numeric``, ``boolean`` or ``scalar``."""
    families = {
        "string": lambda t: isinstance(t, T.StringType),
        "numeric": lambda t: isinstance(t, T.NumericType),
        "boolean": lambda t: isinstance(t, T.BooleanType),
        "scalar": lambda t: not isinstance(t, (T.ArrayType, T.MapType, T.StructType)),
    }
    return [f.name for f in df.schema.fields if families[kind](f.dataType)]


def fill_text(df: DataFrame) -> DataFrame:
    """Empty string for null text; other types keep their nulls."""
    return df.fillna("", subset=columns_of(df, "string"))
