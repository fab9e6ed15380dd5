"""Which terms of a list occur in which texts, as substrings, for lists of any length.

A list of up to ``FEW`` terms becomes a constant and every text is searched for it in place:
nothing is shuffled. A longer one is made into bitmaps of bounded size
(:mod:`trendlake.operators.windows`), by which each task reads the listed strings off its texts,
whatever their number: all of them, and few others, which an equi-join with the list drops. No
text is moved and no place of a text is compared with several terms. What is wanted for each term
alone, such as counts, is aggregated before that join (:func:`per_term`).

Defined results: null texts contain nothing; null and empty terms are in no text; a term that
is listed twice matches twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.operators import windows
from trendlake.session import written_once

FEW = 64
_PART = 15  # logarithm of the bits of one part of a bitmap


def few_rows(terms: DataFrame, few: int = FEW) -> list[Row] | None:
    """The rows of a short list, which the driver may hold; None for a longer one."""
    rows = terms.limit(few + 1).collect()
    return rows if len(rows) <= few else None


def listed_windows(listed: DataFrame) -> windows.Listed:
    """The bitmaps of a table of terms; they have a greatest size, and only they reach the driver."""
    counts = {r["n"]: r["count"] for r in listed.groupBy(F.octet_length("term").alias("n")).count().collect()}
    kinds = windows.kinds_of({n: count for n, count in counts.items() if n})

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in windows.slices(batch, "term"):
                kind, bit = windows.bits_of(piece.column("term"), kinds)
                columns = [kind.astype(np.int32), (bit >> _PART).astype(np.int32), bit & ((1 << _PART) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "part", "bit"])

    held = windows.Listed(kinds)
    parts = listed.select("term").mapInArrow(bits, "kind int, part int, bit long").groupBy("kind", "part")
    for row in parts.agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        start = row["part"] << (_PART - 3)
        held.maps[row["kind"]][start : start + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return held


def occurrences(df: DataFrame, text: str, listed: DataFrame, carry: Sequence[str], first: int | None = None) -> DataFrame:
    """Each row's carried columns with each listed ``term`` of its text, as bytes, and with few strings that are not listed.

    With ``first`` a term is given only for that many rows of a batch, the first that hold it.
    """
    shared = df.sparkSession.sparkContext.broadcast(listed_windows(listed))
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(0)
    narrow = df.select(row.alias("row"), F.col(text).alias("text"))
    schema = T.StructType([narrow.schema["row"], T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in windows.slices(batch, "text"):
                offsets, strings = shared.value.find(piece.column("text"), first)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), strings)
                yield pa.RecordBatch.from_arrays([piece.column("row"), lists], ["row", "terms"])

    found = narrow.mapInArrow(find, schema)
    return found.select(*(F.col("row")[c].alias(c) for c in carry), F.explode("terms").alias("term"))


def per_term(
    df: DataFrame, text: str, terms: DataFrame, work: Callable[[DataFrame], DataFrame], few: int = FEW, first: int | None = None
) -> DataFrame:
    """``work`` on the rows of ``df`` (without the text) with each different ``term`` their text contains.

    ``work`` must treat each term by itself and keep the column; with a long list it comes
    first and strings that are not listed are dropped from its result. Where it needs no more
    than the ``first`` rows of each term, and every partition of ``df`` is in that order, rows
    beyond them are left out early.
    """
    others, different = [c for c in df.columns if c != text], terms.select("term").distinct()
    if few_rows(different, few) is not None:
        return work(with_terms(df, text, different, few).select(*others, "term"))
    listed = written_once(different.filter("term <> ''"))
    done = work(occurrences(df, text, listed, others, first))
    own = listed.select(F.col("term").cast("binary").alias("_bytes"), F.col("term").alias("_term"))
    names = [F.col("_term").alias("term") if c == "term" else F.col(c) for c in done.columns]
    return done.join(own.hint("merge"), F.col("term") == F.col("_bytes")).select(*names)  # a long list is not broadcast


def with_terms(df: DataFrame, text: str, terms: DataFrame, few: int = FEW) -> DataFrame:
    """Each row of ``df`` with each row of ``terms`` whose ``term`` its text contains.

    With a long list texts are known by a hash until they are joined back, so that no text is
    moved once for each of its terms.
    """
    rows = few_rows(terms, few)
    if rows is not None:
        entry = f"array<struct<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in terms.schema)}>>"
        listed = F.array(*(F.struct(*(F.lit(r[c]).alias(c) for c in terms.columns)) for r in rows if r["term"])).cast(entry)
        return df.select(*df.columns, F.inline(F.filter(listed, lambda t: F.contains(F.col(text), t["term"]))))
    stored = written_once(terms.filter("term <> ''"))
    hashed = df.withColumn("_hash", F.xxhash64(text))
    found = occurrences(hashed, text, stored.select("term").distinct(), ["_hash"]).distinct()
    beside = stored.select(F.col("term").cast("binary").alias("_bytes"), *(F.col(c).alias(f"_of_{c}") for c in terms.columns))
    hits = found.join(beside, F.col("term") == F.col("_bytes")).drop("term", "_bytes")
    joined = hashed.join(hits, "_hash").filter(F.contains(text, "_of_term"))
    return joined.select(*df.columns, *(F.col(f"_of_{c}").alias(c) for c in terms.columns))
