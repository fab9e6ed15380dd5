"""Batches that repeat a stored batch's set of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digest_parts(value: Column) -> list[Column]:
    """Four 60-bit integers of the SHA-256 of an id; null has its own."""
    digest = F.sha2(F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null")), 256)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]


def batch_fingerprints(df: DataFrame, batch: Sequence[str], key: str) -> DataFrame:
    """Per batch the size of its id set and digest sums that do not depend on order.

    Equal sets have equal fingerprints, and the 240 summed digest bits tell
    different sets apart; a batch's ids are never gathered in one place.
    """
    ids = df.select(*batch, key).distinct()
    sums = [F.sum(part).alias(f"h{i}") for i, part in enumerate(_digest_parts(F.col(key)))]
    return ids.groupBy(*batch).agg(F.count("*").alias("ids"), *sums)


def repeated_batches(new: DataFrame, stored: DataFrame, batch: str, day: str, key: str) -> DataFrame:
    """``batch`` and ``day`` of new batches whose id set equals a stored batch of the same day."""
    known = batch_fingerprints(stored, [day, batch], key).drop(batch).distinct()
    candidates = batch_fingerprints(new, [day, batch], key)
    return candidates.join(known, [day, "ids", "h0", "h1", "h2", "h3"], "left_semi").select(day, batch)


def skip_repeated_batches(new: DataFrame, stored: DataFrame, batch: str, day: str, key: str) -> DataFrame:
    """Rows of the new batches that do not repeat a stored batch."""
    return new.join(repeated_batches(new, stored, batch, day, key), [day, batch], "left_anti").select(*new.columns)
