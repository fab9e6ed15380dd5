"""Exact deduplication with an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normalised form. A histogram of key prefixes gives
the directory: it doubles, and overfull buckets split, until each bucket holds at most
``capacity`` distinct keys or the directory has ``2 ** max_depth`` slots. Copies within a
batch are merged by their bytes before anything is moved, so that a group of copies
reaches its owner as one row for each batch. The task that owns a bucket reads its keys
in order; different texts with one key form a chain, in which bytes are compared. The
entries of all buckets are written to the shared folder and joined back to the rows.

Defined results: null text is empty text; texts are equal when they are identical after
A-Z are lower-cased; of equal texts the row with the largest key column stays, a null
key last of all; of rows that are equal in both, one stays. Rows are never lost: every
input row comes back once, with all its columns inside ``row``. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.columnar import map_batches, text_column
from trendlake.llm.tables import Scratch

CAPACITY = 1_024
MAX_DEPTH = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def build_directory(cells: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each directory slot, and each bucket's own depth.

    ``cells`` has the number of keys for each prefix of the greatest allowed depth; its
    size is a power of two. Buckets are numbered in key order, so each is a key range.
    """
    below = np.concatenate([[0], np.cumsum(cells, dtype=np.int64)])
    max_depth = len(cells).bit_length() - 1
    depth, waiting, leaves = 0, [(0, 0)], []  # (own depth, prefix)
    while waiting:
        own, prefix = waiting.pop()
        width = max_depth - own
        held = below[(prefix + 1) << width] - below[prefix << width]
        if held > capacity and own < max_depth:
            depth = max(depth, own + 1)  # the directory doubles when a bucket outgrows it
            waiting += [(own + 1, 2 * prefix), (own + 1, 2 * prefix + 1)]
        else:
            leaves.append((prefix << width, own))
    leaves.sort()
    depths = np.array([own for _, own in leaves])
    return np.repeat(np.arange(len(leaves)), 1 << (depth - depths)), depths


def merge_copies(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of a batch with identical bytes as one row."""
    coded = batch.column("body").dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    known = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
    ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, known, code))  # the row to keep comes last within its text
    ends = np.cumsum(np.bincount(code, minlength=len(coded.dictionary))) - 1
    last = order[ends]
    tied = (known == known[last][code]) & (ids == ids[last][code])
    columns = [
        batch.column("bucket").take(pa.array(last)), batch.column("h").take(pa.array(last)), coded.dictionary,
        pa.array(np.bincount(code)), batch.column("id").take(pa.array(last)), pa.array(np.bincount(code[tied])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "h", "body", "n", "keep", "n_keep"])


class Chain:
    """Different texts that share one key, each with its copies' count and the row to keep."""

    def __init__(self) -> None:
        self.nodes: list[list] = []

    def add(self, body: bytes, n: int, keep: int | None, n_keep: int) -> None:
        for node in self.nodes:
            if node[0] == body:
                node[1] += n
                if keep == node[2]:
                    node[3] += n_keep
                elif keep is not None and (node[2] is None or keep > node[2]):
                    node[2:] = [keep, n_keep]
                return
        self.nodes.append([body, n, keep, n_keep])


def own_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the buckets whose rows arrive here in (bucket, key) order."""
    names = ["bucket", "h", "chain", "sha", "n", "keep", "n_keep"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def entries(closed: list[tuple[int, int, Chain]]) -> pa.RecordBatch:
        rows = [
            (bucket, h, i, hashlib.sha256(node[0]).hexdigest(), *node[1:])
            for bucket, h, chain in closed for i, node in enumerate(chain.nodes)
        ]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    place, chain = None, Chain()
    for batch in batches:
        closed = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:2] != place:
                if place is not None:
                    closed.append((*place, chain))
                place, chain = row[:2], Chain()
            chain.add(*row[2:])
        yield entries(closed)
    if place is not None:
        yield entries([(*place, chain)])


def build_index(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> DataFrame:
    """Write the index of ``docs``; a table with one entry for each different text."""
    spark = docs.sparkSession
    body = ascii_lower(F.col(text))
    keyed = docs.select(F.col(key).cast("long").alias("id"), body.alias("body"), F.xxhash64(body).alias("h"))
    cell = F.shiftrightunsigned("h", 64 - max_depth).cast("int")
    found = keyed.select("h").distinct().groupBy(cell.alias("cell")).count().collect()  # at most 2 ** max_depth rows
    cells = np.zeros(1 << max_depth, np.int64)
    for row in found:
        cells[row["cell"]] = row["count"]
    slots, _ = build_directory(cells, capacity)
    depth = len(slots).bit_length() - 1
    directory = spark.createDataFrame(list(enumerate(slots.tolist())), "slot int, bucket int")
    directory = scratch.write(directory.coalesce(1), "directory")
    slot = F.shiftrightunsigned("h", 64 - depth).cast("int") if depth else F.lit(0)
    placed = keyed.withColumn("slot", slot).join(F.broadcast(directory), "slot")  # bounded by 2 ** max_depth slots
    placed = placed.select("bucket", "h", F.col("body").cast("binary").alias("body"), "id")
    schema = "bucket int, h long, body binary, n long, keep long, n_keep long"
    merged = map_batches(placed, "body", merge_copies, schema)
    owned = merged.repartition("bucket").sortWithinPartitions("bucket", "h")
    schema = "bucket int, h long, chain int, sha string, n long, keep long, n_keep long"
    return scratch.write(owned.mapInArrow(own_buckets, schema), "entries")


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None, **options) -> DataFrame:
    """(row, keep_id, group_size, kept, text_sha256) of every row; ``row`` has the columns in ``carry`` (all)."""
    scratch = Scratch(docs.sparkSession, "exact")
    entries = build_index(docs, scratch, key, text, **options)
    body = ascii_lower(F.col(text))
    rows = docs.select(
        F.struct(*(F.col(c) for c in carry or docs.columns)).alias("row"), F.col(key).cast("long").alias("id"),
        F.xxhash64(body).alias("h"), F.sha2(body, 256).alias("sha"),
    )
    groups = entries.filter("n > 1").select("h", "sha", "n", "keep", "n_keep")
    joined = rows.join(groups, ["h", "sha"], "left")
    best = F.col("n").isNull() | F.col("id").eqNullSafe(F.col("keep"))
    tied = best & (F.coalesce("n_keep", F.lit(1)) > 1)
    result = [
        "row", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"), "kept", F.col("sha").alias("text_sha256"),
    ]
    if groups.filter("n_keep > 1").isEmpty():
        return joined.withColumn("kept", best).select(*result)
    # Rows that are equal in text and key: number them in a written table and keep the first of each group.
    equal = scratch.write(joined.filter(tied).withColumn("at", F.monotonically_increasing_id()), "tied")
    first = equal.groupBy("h", "sha").agg(F.min("at").alias("first"))
    chosen = equal.join(first, ["h", "sha"]).withColumn("kept", F.col("at") == F.col("first"))
    return joined.filter(~tied).withColumn("kept", best).select(*result).unionByName(chosen.select(*result))
