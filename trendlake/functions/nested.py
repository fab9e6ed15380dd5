"""Nested JSON values to flat columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def array_to_csv(values: Column) -> Column:
    """Elements as text joined by comma and space; a null array stays null."""
    return F.array_join(F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("None"))), ", ")


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Every array of scalars becomes CSV text; arrays of structs become JSON text."""
    flat = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            nested = isinstance(field.dataType.elementType, (T.StructType, T.ArrayType, T.MapType))
            flat[field.name] = F.to_json(field.name) if nested else array_to_csv(F.col(field.name))
    return df.withColumns(flat) if flat else df


def ingredient_names(ingredients: Column) -> Column:
    """Names of an ingredient list as CSV; a null list gives empty text."""
    named = F.filter(ingredients, lambda i: i["name"] != "")
    return F.coalesce(F.array_join(F.transform(named, lambda i: F.trim(i["name"])), ", "), F.lit(""))


def instruction_text(blocks: Column) -> Column:
    """Steps of all instruction blocks, in order, joined by a space."""
    present = F.filter(F.transform(blocks, lambda b: b["steps"]), lambda s: s.isNotNull())
    steps = F.filter(F.flatten(present), lambda s: s["step"] != "")
    return F.coalesce(F.array_join(F.transform(steps, lambda s: F.trim(s["step"])), " "), F.lit(""))


def flag_tags(flags: Mapping[str, str]) -> Column:
    """Tags of the boolean columns that are true; false and null give no tag."""
    return F.array_compact(F.array(*[F.when(F.col(c), F.lit(tag)) for c, tag in flags.items()]))
