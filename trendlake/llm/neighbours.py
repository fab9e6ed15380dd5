"""Embedding near-duplicates by NN-descent: links of a least cosine, their components and counts.

1. Equal vectors are one class; a class has its vector and a 16-bit code of its unit vector.
2. *First graph.* ``TREES`` times, random hyperplanes (cut at medians of a bounded sample) deal
   the classes into leaves of about ``LEAF``; a leaf of more than ``BLOCK`` is dealt out further
   at random. Each leaf gives every class its nearest ``SIZE`` neighbours of at least ``floor``
   (the cosine of twice the link's angle: two links in a row reach no further).
3. *Descent.* Neighbours of neighbours are compared at every class of the graph, and lists take
   the nearest, until lists gain next to nothing. Lists that are full of links are saturated
   and get twice the room in each round.
4. *Links.* Wherever classes are compared, those surely linked by their codes are tied to the
   least of their set, so that no list's length can part a component. Pairs within the codes'
   error of the threshold are compared as doubles.
5. *Counts.* Links lie inside components. Each component is compared exactly, in doubles: a small
   one in one task; in a large one the members within half the link's angle of its centre are
   linked with each other by the triangle inequality, and only the others are compared, in
   blocks. A group of copies that holds a third of all rows therefore costs one pass.
6. *Audit.* ``AUDIT`` classes are compared with all. While fewer than ``recall`` of their links
   are found, another pass of trees and descent adds to the graph.

The driver gets the sample (``SAMPLE`` vectors), the audit's vectors and counts, and totals.

Defined results: null, zero and empty vectors and those with null or non-finite components link
with nothing and have no links; vectors of different length are not compared; rows with one key
are several vectors; a component's id is its least key that is not null, and a row with a null
key is not kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from math import acos, ceil, cos, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.components import connected
from trendlake.llm.tables import Scratch

COSINE = 0.9
SIZE = 12  # neighbours that a list holds before it is found saturated
WIDEST = 32  # neighbours of a class that one descent compares with each other
TREES = 4
LEAF, BLOCK = 1_024, 2_048
PART = 2_048  # members of a component that one task compares with each other
ROUNDS = 4
GAIN = 0.01
SAMPLE, AUDIT = 4_096, 1_024
RECALL, PASSES = 0.995, 6
HELD = 500_000  # rows that a task thins out before it gives them away
ROWS = 512  # rows of a product of matrices that are held at once
LISTED, TIED, DOUBTED = range(3)
FOUND = "kind int, a long, b long, sim float"

log = logging.getLogger(__name__)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, as doubles; scaled first, so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _by_length(raw: list[bytes], dtype: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(raw[i] for i in at.tolist()), dtype).reshape(len(at), -1)


def _error(width: int) -> float:
    """The most by which the product of two codes differs from the cosine."""
    return sqrt(width) / 32_767 + 1e-5


def prepared(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, digest, raw) of every row; digest and raw are null where a vector links with nothing."""
    wide = rows.schema[vector].dataType.elementType.simpleString() != "float"
    dtype = np.dtype("<f8" if wide else "<f4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            raw: list[bytes | None] = [None] * len(lists)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(dtype)  # null components become NaN
            ends = lists.offsets.to_numpy()
            for i, (a, b, known) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), lists.is_valid().to_pylist(), strict=True)):
                own = flat[a:b]
                if known and np.isfinite(own).all() and own.any():
                    raw[i] = (own + dtype.type(0)).tobytes()  # -0.0 becomes 0.0
            digests = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], ["id", "digest", "raw"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("id"), F.col(vector).alias("vector")).mapInArrow(run, f"id {kind}, digest binary, raw binary")


def with_codes(classes: DataFrame, dtype: str) -> DataFrame:
    """The classes with ``code``, the unit vector in 16-bit steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            codes: list[bytes] = [b""] * len(raw)
            for at, matrix in _by_length(raw, dtype):
                for i, code in zip(at.tolist(), np.rint(_unit(matrix) * 32_767).astype("<i2"), strict=True):
                    codes[i] = code.tobytes()
            yield batch.append_column("code", pa.array(codes, pa.binary()))

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{columns}, code binary")


class Trees:
    """Random hyperplanes for vectors of any length; cuts at medians for the length that the sample has most of."""

    def __init__(self, sample: list[bytes], n: int, seed: int):
        self.depth, self.seed = max(0, ceil(log2(max(1, n) / LEAF))), seed
        most = max(_by_length(sample, "<i2"), key=lambda x: len(x[0]), default=None)
        self.width, self.cuts = (most[1].shape[1], np.median(most[1] @ self.planes(most[1].shape[1]), axis=0)) if most else (0, None)

    def planes(self, width: int) -> np.ndarray:
        return np.random.default_rng((self.seed, width)).normal(size=(width, TREES * self.depth))

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every vector in each tree."""
        width = codes.shape[1]
        above = (codes @ self.planes(width) > (self.cuts if width == self.width else 0)).reshape(len(codes), TREES, self.depth)
        return above @ (np.int64(1) << np.arange(self.depth, dtype=np.int64))


def _leaf_rows(codes: DataFrame, trees: Trees, whole: bool) -> DataFrame:
    """(tree, leaf, cls, code) of every class and tree; or (tree, leaf, n), counted for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("code").to_pylist()
            leaf = np.zeros((len(raw), TREES), np.int64)
            for at, matrix in _by_length(raw, "<i2"):
                leaf[at] = trees.leaves(matrix)
            for tree in range(TREES):
                if whole:
                    columns = [pa.array(np.full(len(raw), tree, np.int32)), pa.array(leaf[:, tree]), batch.column("cls"), batch.column("code")]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "cls", "code"])
                else:
                    own, n = np.unique(leaf[:, tree], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), tree, np.int32)), pa.array(own), pa.array(n)], ["tree", "leaf", "n"])

    return codes.select("cls", "code").mapInArrow(run, "tree int, leaf long, " + ("cls long, code binary" if whole else "n long"))


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    place, held = None, []
    for batch in batches:
        values = np.stack([batch.column(c).to_numpy() for c in keys])
        edges = np.concatenate([[0], np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            here = tuple(values[:, a].tolist()) if b > a else place
            if here != place and held:
                yield pa.Table.from_batches(held)
                held = []
            place = here
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _least_of_sets(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least one that the edges (a, b) lead to."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def compare(cls: np.ndarray, raw: list[bytes], size: int, floor: float, cosine: float) -> list[np.ndarray]:
    """What a set of classes, compared by codes, gives: (kind, a, b, sim) of list entries, ties and doubtful pairs."""
    out = []
    order = np.argsort(cls, kind="stable")
    cls, raw = cls[order], [raw[i] for i in order.tolist()]
    for at, codes in _by_length(raw, "<i2"):
        own, unit, error = cls[at], codes.astype(np.float32) / 32_767, _error(codes.shape[1])
        tied: list[np.ndarray] = []
        for start in range(0, len(own), ROWS):
            sims = unit[start : start + ROWS] @ unit.T
            row, col = np.nonzero(sims >= floor)
            sim, row = sims[row, col], row + start
            other = row != col
            row, col, sim = row[other], col[other], sim[other]
            upper = row < col
            sure = upper & (sim >= cosine + error)
            tied.append(np.stack([row[sure], col[sure]]))
            doubt = upper & ~sure & (sim >= cosine - error)
            out.append(_rows(DOUBTED, own[row[doubt]], own[col[doubt]], sim[doubt]))
            best = np.lexsort((col, -sim, row))
            row, col, sim = row[best], col[best], sim[best]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            near = rank < size
            out.append(_rows(LISTED, own[row[near]], own[col[near]], sim[near]))
        pairs = np.concatenate(tied, axis=1) if tied else np.zeros((2, 0), np.int64)
        root = _least_of_sets(len(own), pairs[0], pairs[1])
        tie = np.flatnonzero(root != np.arange(len(own)))
        out.append(_rows(TIED, own[tie], own[root[tie]], np.ones(len(tie))))
    return out


def _rows(kind: int, a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> np.ndarray:
    return np.rec.fromarrays([np.full(len(a), kind, np.int32), a, b, sim.astype(np.float32)], names=["kind", "a", "b", "sim"])


def nearest_rows(rows: np.ndarray, size: int) -> np.ndarray:
    """Every pair of a kind once, and of the list entries each class's nearest ``size``."""
    rows = rows[np.lexsort((rows["b"], rows["a"], rows["kind"]))]
    new = np.ones(len(rows), bool)
    new[1:] = np.any([rows[c][1:] != rows[c][:-1] for c in ("kind", "a", "b")], axis=0)
    rows = rows[new]
    listed = rows[rows["kind"] == LISTED]
    listed = listed[np.lexsort((listed["b"], -listed["sim"], listed["a"]))]
    rank = np.arange(len(listed)) - np.searchsorted(listed["a"], listed["a"])
    return np.concatenate([rows[rows["kind"] != LISTED], listed[rank < size]])


def _compared(sets: DataFrame, keys: tuple[str, ...], size: int, floor: float, cosine: float) -> DataFrame:
    """:func:`compare` over every key's rows (cls, code)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for group in _groups(batches, keys):
            cls, first = np.unique(group["cls"].to_numpy(), return_index=True)
            raw = group["code"].to_pylist()
            parts = compare(cls, [raw[i] for i in first.tolist()], size, floor, cosine)
            held, n = held + [p for p in parts if len(p)], n + sum(map(len, parts))
            if n > HELD:
                yield batch_of(held)
                held, n = [], 0
        if held:
            yield batch_of(held)

    def batch_of(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = nearest_rows(np.concatenate(parts), size)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c])) for c in rows.dtype.names], list(rows.dtype.names))

    return sets.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, FOUND)


def first_graph(classes: DataFrame, trees: Trees, scratch: Scratch, floor: float, cosine: float) -> DataFrame:
    """What the classes of each leaf, compared with each other, give."""
    sizes = _leaf_rows(classes, trees, whole=False).groupBy("tree", "leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > BLOCK)
    large = scratch.write(sizes.select("tree", "leaf", F.ceil(F.col("n") / BLOCK).alias("parts")), f"large-{trees.seed}")
    salt = F.pmod(F.xxhash64("cls", F.lit(trees.seed), "tree"), F.coalesce("parts", F.lit(1)))
    rows = _leaf_rows(classes, trees, whole=True).join(large, ["tree", "leaf"], "left").select("tree", "leaf", salt.alias("salt"), "cls", "code")
    return _compared(rows, ("tree", "leaf", "salt"), SIZE, floor, cosine)


def nearest(found: DataFrame, size: int, cosine: float) -> DataFrame:
    """(a, b, sim): each class's nearest neighbours, ``SIZE``, and up to ``size`` where they are links."""
    once = found.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))).filter(F.col("rank") <= size)
    return ranked.filter((F.col("rank") <= SIZE) | (F.col("sim") >= cosine)).drop("rank")


def descend(graph: DataFrame, active: DataFrame, size: int, floor: float, cosine: float) -> DataFrame:
    """What the neighbours of each class, either way, give when they are compared with each other."""
    both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")).distinct()
    near = both.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))).filter(F.col("rank") <= min(2 * size, WIDEST))
    sets = near.select(F.col("a").alias("middle"), F.col("b").alias("cls")).join(active.select("cls", "code"), "cls")
    return _compared(sets.select("middle", "cls", "code"), ("middle",), size, floor, cosine)


def _gained(graph: DataFrame) -> float:
    return graph.agg(F.sum("sim")).first()[0] or 0.0


def _verified(pairs: DataFrame, active: DataFrame, dtype: str, cosine: float) -> DataFrame:
    """The pairs (a, b) whose cosine, as doubles, is at least ``cosine``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            linked = np.zeros(len(x), bool)
            for at, left in _by_length(x, dtype):
                right = np.frombuffer(b"".join(y[i] for i in at.tolist()), dtype).reshape(left.shape)
                linked[at] = (_unit(left) * _unit(right)).sum(axis=1) >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    raw = active.select("cls", "raw")
    rows = pairs.join(raw.toDF("a", "x"), "a").join(raw.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long")


def _centres(members: DataFrame, dtype: str) -> DataFrame:
    """(grp, centre): the sum of each group's unit vectors, added up by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp, raw = batch.column("grp").to_numpy(), batch.column("raw").to_pylist()
            for at, matrix in _by_length(raw, dtype):
                own, code = np.unique(grp[at], return_inverse=True)
                sums = np.zeros((len(own), matrix.shape[1]))
                np.add.at(sums, code, _unit(matrix))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(list(sums))], ["grp", "part"])

    parts = members.select("grp", "raw").mapInArrow(run, "grp long, part array<double>").select("grp", F.posexplode("part").alias("i", "v"))
    sums = parts.groupBy("grp", "i").agg(F.sum("v").alias("v"))
    return sums.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("centre"))


def _outside(members: DataFrame, dtype: str, cosine: float) -> DataFrame:
    """(grp, cls, copies, raw, rest): whether a member is further from its group's centre than half the link's angle."""
    half = cos(acos(cosine) / 2) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, centres = batch.column("raw").to_pylist(), batch.column("centre").to_pylist()
            rest = np.ones(len(raw), bool)
            for at, matrix in _by_length(raw, dtype):
                centre = np.array([centres[i] for i in at.tolist()])
                length = np.linalg.norm(centre, axis=1)
                rest[at] = (_unit(matrix) * centre).sum(axis=1) < half * np.where(length > 0, length, np.inf)
            yield batch.select(["grp", "cls", "copies", "raw"]).append_column("rest", pa.array(rest))

    rows = members.join(_centres(members, dtype), "grp").select("grp", "cls", "copies", "raw", "centre")
    return rows.mapInArrow(run, "grp long, cls long, copies long, raw binary, rest boolean")


ASKS, ANSWERS = 1, 2


def _block_links(blocks: DataFrame, dtype: str, cosine: float) -> DataFrame:
    """(cls, links) of the classes of every block (grp, i, j): asking ones count all answering ones, those that only answer count the asking ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for group in _groups(batches, ("grp", "i", "j")):
            cls, copies, role = (group[c].to_numpy() for c in ("cls", "copies", "role"))
            core, raw = group["core"].to_numpy(), group["raw"].to_pylist()
            for at, matrix in _by_length(raw, dtype):
                unit, links = _unit(matrix), np.zeros(len(at), np.int64)
                ask, answer = np.flatnonzero(role[at] & ASKS), np.flatnonzero(role[at] & ANSWERS)
                for start in range(0, len(ask), ROWS):
                    own = ask[start : start + ROWS]
                    linked = (unit[own] @ unit[answer].T >= cosine) & (cls[at][own][:, None] != cls[at][answer])
                    links[own] += linked @ copies[at][answer]
                    links[answer] += np.where(core[at][answer], copies[at][own] @ linked, 0)
                held.append((cls[at], links))
            if sum(len(c) for c, _ in held) > 50_000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    def batch_of(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["cls", "links"])

    spread = blocks.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    return spread.mapInArrow(run, "cls long, links long")


def count_links(members: DataFrame, scratch: Scratch, name: str, dtype: str, cosine: float) -> DataFrame:
    """(cls, links): the exact number of other rows that each member (grp, cls, copies, raw) of a component is linked with."""
    sizes = members.groupBy("grp").agg(F.count("*").alias("m"))
    members = scratch.write(members.join(sizes, "grp"), f"{name}-members")
    small = members.filter(F.col("m") <= PART).select(
        "grp", F.lit(0).alias("i"), F.lit(0).alias("j"), "cls", "copies", "raw", F.lit(ASKS | ANSWERS).alias("role"), F.lit(False).alias("core")
    )
    blocks, large = small, members.filter(F.col("m") > PART)
    sure = None
    if not large.isEmpty():
        placed = scratch.write(_outside(large, dtype, cosine), f"{name}-placed")
        core = F.when(~F.col("rest"), F.col("copies"))
        totals = placed.groupBy("grp").agg(F.coalesce(F.sum(core), F.lit(0)).alias("inside"), F.count("*").alias("m"), F.count(F.when(F.col("rest"), 1)).alias("asking"))
        asked = placed.join(totals, "grp")
        sure = asked.filter("not rest").select("cls", (F.col("inside") - F.col("copies")).alias("links"))
        cut = lambda n: F.ceil(F.col(n) / PART).cast("int")
        part = lambda n, seed: F.pmod(F.xxhash64("cls", F.lit(seed)), cut(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), cut(n) - 1))
        open_ones = asked.filter("asking > 0")
        asks = open_ones.filter("rest").withColumns({"i": part("asking", 1), "role": F.lit(ASKS)}).withColumn("j", every("m"))
        answers = open_ones.withColumns({"j": part("m", 2), "role": F.lit(ANSWERS)}).withColumn("i", every("asking"))
        blocks = small.unionByName(asks.unionByName(answers).withColumn("core", ~F.col("rest")).select(small.columns))
    links = _block_links(blocks, dtype, cosine)
    return scratch.write((links.unionByName(sure) if sure is not None else links).groupBy("cls").agg(F.sum("links").alias("links")), f"{name}-links")


def audit(classes: DataFrame, counted: DataFrame, n: int, seed: int, dtype: str, cosine: float) -> float:
    """The share of all links of a sample of classes that ``counted`` (cls, links) has; the sample is compared with every row."""
    sample = {r.cls: bytes(r.raw) for r in classes.select("cls", "raw").sample(min(1.0, 1.3 * AUDIT / n), seed).limit(AUDIT).collect()}
    ids, queries = np.array(list(sample), np.int64), [(at, _unit(m)) for at, m in _by_length(list(sample.values()), dtype)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = np.zeros(len(ids), np.int64)
        for batch in batches:
            cls, copies, raw = batch.column("cls").to_numpy(), batch.column("copies").to_numpy(), batch.column("raw").to_pylist()
            for at, matrix in _by_length(raw, dtype):
                unit = _unit(matrix)
                for places, asked in queries:
                    if asked.shape[1] == unit.shape[1]:
                        for start in range(0, len(unit), ROWS):
                            own = at[start : start + ROWS]
                            linked = (asked @ unit[start : start + ROWS].T >= cosine) & (ids[places][:, None] != cls[own])
                            links[places] += linked @ copies[own]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], ["cls", "truth"])

    truth = classes.select("cls", "copies", "raw").mapInArrow(run, "cls long, truth long").groupBy("cls").agg(F.sum("truth").alias("truth"))
    both = truth.join(counted, "cls", "left").agg(F.sum("truth"), F.sum(F.coalesce("links", F.lit(0)))).first()
    return both[1] / both[0] if both[0] else 1.0


def similar_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    scratch = Scratch(rows.sparkSession, "neighbours")
    dtype = "<f4" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    floor = cos(min(2 * acos(cosine), acos(-1.0)))
    marks = scratch.write(prepared(rows, key, vector), "marks")
    once = marks.filter("raw is not null").groupBy("digest", "raw").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    classes = scratch.write(with_codes(once.withColumn("cls", F.monotonically_increasing_id()), dtype), "classes")
    ids = scratch.write(marks.select("id", "digest"), "ids")
    scratch.drop("marks")
    n = classes.count()
    sample = [bytes(r.code) for r in classes.select("code").sample(min(1.0, 1.3 * SAMPLE / max(1, n)), 0).limit(SAMPLE).collect()]

    graph, links, members = None, None, None
    for turn in range(PASSES if n > 1 else 0):
        found = scratch.write(first_graph(classes, Trees(sample, n, turn), scratch, floor, cosine), f"found-{turn}-0")
        ties = [found.filter(F.col("kind") == TIED).select("a", "b")]
        doubts = [found.filter(F.col("kind") == DOUBTED).select("a", "b")]
        listed = found.filter(F.col("kind") == LISTED).select("a", "b", "sim")
        graph = scratch.write(nearest(listed if graph is None else graph.unionByName(listed), SIZE, cosine), f"graph-{turn}-0")
        nodes = graph.select(F.col("a").alias("cls")).unionByName(graph.select(F.col("b").alias("cls"))).distinct()
        active = scratch.write(classes.join(nodes, "cls", "left_semi").select("cls", "raw", "code"), f"active-{turn}")
        total = _gained(graph)
        for step in range(1, ROUNDS + 1):
            size = min(SIZE << step, WIDEST)
            found = scratch.write(descend(graph, active, size, floor, cosine), f"found-{turn}-{step}")
            ties.append(found.filter(F.col("kind") == TIED).select("a", "b"))
            doubts.append(found.filter(F.col("kind") == DOUBTED).select("a", "b"))
            listed = found.filter(F.col("kind") == LISTED).select("a", "b", "sim")
            graph, before = scratch.write(nearest(graph.unionByName(listed), size, cosine), f"graph-{turn}-{step}"), total
            total = _gained(graph)
            if total <= before * (1 + GAIN):
                break
        pairs = doubts[0]
        for more in doubts[1:]:
            pairs = pairs.unionByName(more)
        new = _verified(pairs.distinct(), active, dtype, cosine)
        for more in [*ties, *([] if links is None else [links])]:
            new = new.unionByName(more)
        links = scratch.write(new.distinct(), f"links-{turn}")
        roots = scratch.write(connected(links, scratch, f"linked-{turn}"), f"roots-{turn}")
        members = roots.select(F.col("node").alias("cls"), F.col("root").alias("grp")).join(classes.select("cls", "copies", "raw"), "cls")
        counted = count_links(members.select("grp", "cls", "copies", "raw"), scratch, f"count-{turn}", dtype, cosine)
        reached = audit(classes, counted, n, turn, dtype, cosine)
        log.info("pass %d: %.4f of the sample's links found", turn, reached)
        for name in [*(f"found-{turn}-{i}" for i in range(ROUNDS + 1)), f"active-{turn}", f"large-{turn}", f"count-{turn}-members", f"count-{turn}-placed"]:
            scratch.drop(name)
        if reached >= recall:
            break

    known = classes.select("digest", "cls", "copies", "least")
    if members is not None:
        least = roots.join(known, known.cls == roots.node).groupBy("root").agg(F.min("least").alias("component"))
        placed = known.join(roots.withColumnRenamed("node", "cls"), "cls", "left").join(least, "root", "left").join(counted, "cls", "left")
        known = placed.select("digest", "copies", F.coalesce("component", "least").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    else:
        known = known.select("digest", "copies", F.col("least").alias("component"), F.lit(0).alias("links"))
    known = scratch.write(known, "placed")
    scratch.drop("classes", *(x for turn in range(PASSES) for x in (f"links-{turn}", f"roots-{turn}", f"count-{turn}-links", *(f"graph-{turn}-{i}" for i in range(ROUNDS + 1)))))
    result = ids.join(known, "digest", "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(key), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
