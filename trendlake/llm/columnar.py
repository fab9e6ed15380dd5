"""Column-at-a-time helpers for operators that work on text inside Spark tasks.

All of them take Arrow arrays of one record batch and use Arrow or numpy over the
whole batch; nothing here knows about Spark except :func:`map_batches`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
WORD_SPACE = frozenset(b"\x20\x09\x0a\x0b\x0c\x0d")


def column_of(batch: pa.RecordBatch, column: str | tuple[str, str]) -> pa.Array:
    """A column, or the field of a struct column that (column, field) names."""
    return batch.column(column) if isinstance(column, str) else pc.struct_field(batch.column(column[0]), [column[1]])


def slices(batch: pa.RecordBatch, column: str | tuple[str, str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose ``column`` holds about ``limit`` bytes each (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()  # a worker lives on, and its memory counts for the executor


def map_batches(
    df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = SLICE_BYTES
) -> DataFrame:
    """``work`` over the rows of ``df``, in pieces of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column, limit):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def text_column(batch: pa.RecordBatch, column: str | tuple[str, str]) -> pa.Array:
    """The text of a batch, null read as empty, without an offset into shared buffers."""
    return pa.concat_arrays([pc.fill_null(column_of(batch, column), "")])


def with_row(docs: DataFrame, text: str, carry: list[str] | None, *others: Column) -> tuple[DataFrame, str | tuple[str, str]]:
    """``docs`` as a struct ``row`` of the carried columns (all) and ``others``, and where the text is.

    A text that is carried is not passed a second time.
    """
    names = docs.columns if carry is None else carry
    row = F.struct(*(F.col(c) for c in names)) if names else F.lit(0)
    if text in names:
        return docs.select(row.alias("row"), *others), ("row", text)
    return docs.select(row.alias("row"), *others, F.col(text).alias("text")), "text"


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text array and the offset at which each text starts (one more at the end)."""
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def total_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between consecutive offsets; rows may be empty."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


class Words:
    """Words of a batch of texts: for each occurrence its code, for each code its word.

    ``offsets`` has where each text's occurrences start. A word is a run of characters
    other than space and U+0009 to U+000D.
    """

    def __init__(self, texts: pa.Array):
        pieces = pc.ascii_split_whitespace(texts)
        flat = pieces.flatten()
        real = pc.greater(pc.binary_length(flat), 0)
        kept = real.to_numpy(zero_copy_only=False)
        starts = pieces.offsets.to_numpy().astype(np.int64)
        starts = starts - starts[0]
        self.offsets = np.concatenate([[0], np.cumsum(kept)])[starts]
        coded = flat.filter(real).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each occurrence's word."""
        return hash_strings(self.distinct)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)


def hash_strings(strings: pa.Array) -> np.ndarray:
    if not len(strings):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(strings.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def chained(*columns: np.ndarray) -> np.ndarray:
    """One hash for each row of several columns of hashes; their order counts."""
    state = np.full(len(columns[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for column in columns:
        with np.errstate(over="ignore"):
            state = mixed(state * np.uint64(3) + column)
    return state


def window_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words inside a text, and each text's offsets into them.

    Window ``i`` of a text starts at its word ``i``; a shorter text has none.
    """
    counts = np.maximum(np.diff(offsets) - (width - 1), 0)
    ends = np.concatenate([[0], np.cumsum(counts)])
    starts = ragged(offsets[:-1], counts)
    return chained(*(words[starts + i] for i in range(width))), ends


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)
