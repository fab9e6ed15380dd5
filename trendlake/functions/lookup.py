"""Constant lookups evaluated inside a row.

A small table becomes one literal, split into hash buckets so that a lookup
costs a few comparisons whatever the table's size. The work stays in the JVM,
no join and no shuffle. Callers bound the table.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping
from functools import lru_cache, partial

from pyspark.sql import Column
from pyspark.sql import functions as F

@lru_cache(maxsize=32)
def _buckets(items: tuple[tuple[str, object], ...]) -> str:
    size = max(1, len(items) // 4)
    buckets: list[dict] = [{} for _ in range(size)]
    for key, value in items:
        buckets[zlib.crc32(key.encode("utf-8")) % size][key] = value
    return json.dumps(buckets)


def bucket_table(table: Mapping[str, object], value_type: str) -> Column:
    """The table as one constant: an array of small maps, keyed by hash bucket."""
    return F.from_json(F.lit(_buckets(tuple(table.items()))), f"array<map<string,{value_type}>>")


def look_up(table: Column, key: Column) -> Column:
    """Value of a key in a bucket table, or null."""
    slot = (F.crc32(key.cast("binary")) % F.size(table) + 1).cast("int")
    return F.element_at(F.element_at(table, slot), key)


def constant_lookup(table: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """A function Column -> Column that maps a string key to its value or null."""
    return partial(look_up, bucket_table(table, value_type))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)
