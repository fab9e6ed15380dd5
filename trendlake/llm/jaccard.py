"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their groups.

Texts are lower-cased (A-Z) and cut into words; a document's set has the hashes of its
distinct ``width``-word shingles, or of the whole sequence when it has fewer words. Two
documents are linked when ``100 * intersection >= percent * union``.

1. Documents with equal sets are one class, so copies take part once.
2. A global token order: tokens whose hash is divisible by ``sparse`` come first, rarest
   first by their document frequency over the whole corpus; the others follow by hash.
   Any order gives all links; this one leaves few lists while only a part of the tokens
   is counted. Each class's prefix in this order is indexed; a token of one class alone
   is dropped. Similar classes share a prefix token and lie in one or two neighbouring
   size bands, so each list and band gives a star of edges, never pairs.
3. Components of those edges hold all links between them. Each is joined exactly in a
   task (:mod:`trendlake.llm.setjoin`); one with more than ``GROUP_TOKENS`` tokens or
   ``GROUP_SETS`` sets is cut into parts, and every two parts are a task.
4. Linked classes form the final components, and the result is joined back to the rows.

64-bit hashes stand for words and shingles.

Defined results: null text is empty text; a document without words has an empty set and
is linked with nothing, not even with another such; rows with one key are one document
with several texts as far as the group's least key goes; a class that has only null keys
is linked with nothing and has a null group; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.columnar import Words, chained, map_batches, text_column, total_by_row, window_hashes
from trendlake.llm.components import connected
from trendlake.llm.setjoin import Group, prefix_length
from trendlake.llm.tables import Scratch

WIDTH, PERCENT = 5, 80
SPARSE = 4
GROUP_TOKENS = 4_000_000
GROUP_SETS = 8_192


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text's set, and the sets: distinct hashes in ascending order."""
    words = Words(pc.ascii_lower(texts))
    own, offsets = words.hashes(), words.offsets
    hashes, ends = window_hashes(own, offsets, width)
    counts = np.diff(ends)
    short = np.flatnonzero((np.diff(offsets) > 0) & (counts == 0))
    if len(short):  # the whole sequence, with its length, as the one shingle
        whole = []
        for i in short.tolist():
            sequence = own[offsets[i] : offsets[i + 1]]
            whole.append(chained(np.array([len(sequence)], np.uint64), *(sequence[k : k + 1] for k in range(len(sequence))))[0])
        hashes = np.insert(hashes, ends[short], np.array(whole, np.uint64))
        counts[short] = 1
        ends = np.concatenate([[0], np.cumsum(counts)])
    keep = np.ones(len(hashes), bool)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        hashes[a:b].sort()
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[ends[:-1][counts > 0]] = True
    return np.concatenate([[0], np.cumsum(total_by_row(keep, ends))]), hashes[keep]


def _digests(offsets: np.ndarray, sets: np.ndarray) -> pa.Array:
    own = (sets[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    return pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in own], pa.binary())


def _leading(hashes: np.ndarray, percent: int, sparse: int) -> np.ndarray:
    """The tokens of a set that may lie in its prefix: those that come first, and as many others as the prefix needs."""
    n = len(hashes)
    if n * 100 // percent <= n:
        return hashes[:0]  # only an equal set is similar
    first = hashes % np.uint64(sparse) == 0
    lacking = prefix_length(n, percent) - int(first.sum())
    if lacking > 0:
        first[np.flatnonzero(~first)[:lacking]] = True
    return hashes[first]


def signatures(docs: DataFrame, key: str, text: str, width: int, percent: int, sparse: int) -> DataFrame:
    """(id, digest, n, lead) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, sets = shingle_sets(text_column(batch, "text"), width)
        leads = [_leading(sets[a:b], percent, sparse) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in leads])]).astype(np.int32)
        flat = np.concatenate(leads).view(np.int64) if leads else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.RecordBatch.from_arrays([batch.column("id"), _digests(offsets, sets), pa.array(np.diff(offsets)), lists], ["id", "digest", "n", "lead"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return map_batches(rows, "text", run, "id long, digest binary, n long, lead array<long>")


def candidate_groups(classes: DataFrame, scratch: Scratch, percent: int, sparse: int) -> DataFrame:
    """(node, root): components of the classes that share a prefix token at similar sizes."""
    postings = classes.filter("rep is not null").select("cls", "n", F.explode("lead").alias("h"))
    early = F.pmod(F.col("h"), F.lit(sparse)) == 0
    shared = postings.groupBy("h").agg(F.count("*").alias("df")).filter((F.col("df") > 1) | ~early)
    found = postings.join(shared.hint("shuffle_hash"), "h").groupBy("cls").agg(
        F.first("n").alias("n"), F.count(F.when(early, 1)).alias("found"),
        F.array_sort(F.collect_list(F.struct((~early).alias("late"), F.when(early, F.col("df")).otherwise(0).alias("df"), "h"))).alias("tokens"),
    )
    n_early = F.size(F.filter("lead", lambda h: F.pmod(h, F.lit(sparse)) == 0))
    own = classes.select("cls", n_early.alias("early"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("early") - F.col("found"))
    band = F.floor(F.log(F.col("n").cast("double")) / (log(100 / percent) * 1.0001))
    tokens = F.explode(F.slice("tokens", F.lit(1), prefix.cast("int")))
    entries = found.join(own, "cls").filter(prefix > 0).select("cls", band.alias("band"), tokens.alias("t"))
    entries = entries.select("cls", F.col("t.h").alias("h"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    entries = scratch.write(entries, "entries")
    hubs = entries.groupBy("h", "band").agg(F.min("cls").alias("hub"), F.count("*").alias("m")).filter("m > 1")
    edges = entries.join(hubs, ["h", "band"]).select(F.col("cls").alias("a"), F.col("hub").alias("b")).filter("a <> b")
    return scratch.write(connected(edges, scratch, "candidates"), "groups")


def join_tasks(members: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(cls, root, links): exact links inside every candidate group. ``members``: cls, rep, digest, copies, n, grp, parts."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, flat = shingle_sets(text_column(batch, "text"), width)
        same = pc.equal(_digests(offsets, flat), batch.column("digest"))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))
        columns = [batch.column(c) for c in ("grp", "parts", "cls", "copies")]
        return pa.RecordBatch.from_arrays([*columns, lists], ["grp", "parts", "cls", "copies", "tokens"]).filter(same)

    texts = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
    rows = texts.join(members.select("rep", "digest", "grp", "parts", "cls", "copies"), "rep").select("grp", "parts", "cls", "copies", "digest", "text")
    tokens = map_batches(rows, "text", sets, "grp long, parts int, cls long, copies long, tokens array<long>")
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    other = F.explode(F.expr("sequence(0, parts - 1)"))
    spread = tokens.withColumn("part", part).withColumn("other", other)
    spread = spread.select("grp", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "cls", "copies", "tokens")
    spread = spread.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("grp", "i", "j")])
            edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                here = tuple(keys[:, a].tolist())
                if here != place and held:
                    yield joined(held)
                    held = []
                place = here
                held.append(batch.slice(a, b - a))
        if held:
            yield joined(held)

    def joined(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(pieces).combine_chunks()
        cls = table["cls"].to_numpy()
        once = np.concatenate([[True], cls[1:] != cls[:-1]])  # rows that were repeated in the input
        table, cls = table.filter(pa.array(once)), cls[once]
        lists = table["tokens"].combine_chunks()
        own = [np.asarray(x.values) for x in lists]
        copies = table["copies"].to_numpy()
        root, links = Group(own, table["part"].to_numpy(), percent).join(copies)
        return pa.RecordBatch.from_arrays([pa.array(cls), pa.array(cls[root]), pa.array(links)], ["cls", "root", "links"])

    return spread.mapInArrow(run, "cls long, root long, links long")


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, sparse: int = SPARSE
) -> DataFrame:
    """(id, n_shingles, component_id, n_links) of every row; ``id`` is the key column.

    ``component_id`` is the least key that links lead to. ``n_links`` counts the
    documents that are linked with this one directly, those with an equal set included.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    marks = scratch.write(signatures(docs, key, text, width, percent, sparse), "marks")
    classes = marks.filter("n > 0").groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("lead").alias("lead")
    )
    classes = scratch.write(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    ids = scratch.write(marks.select("id", "digest", "n"), "ids")
    scratch.drop("marks")
    groups = candidate_groups(classes, scratch, percent, sparse)
    known = scratch.write(classes.drop("lead"), "known")
    scratch.drop("classes", "entries")

    members = known.join(groups.select(F.col("node").alias("cls"), F.col("root").alias("grp")), "cls")
    weights = members.groupBy("grp").agg(F.sum("n").alias("tokens"), F.count("*").alias("m"))
    parts = F.ceil(F.greatest(F.col("tokens") / GROUP_TOKENS, F.col("m") / GROUP_SETS)).cast("int")
    members = members.join(weights.select("grp", parts.alias("parts")), "grp")
    links = scratch.write(join_tasks(members, docs, key, text, width, percent), "links")

    roots = scratch.write(connected(links.select(F.col("cls").alias("a"), F.col("root").alias("b")), scratch, "linked"), "roots")
    least = roots.join(known.select(F.col("cls").alias("node"), "rep"), "node").groupBy("root").agg(F.min("rep").alias("least"))
    degree = links.groupBy("cls").agg(F.sum("links").alias("links"))
    placed = (
        known.join(roots.withColumnRenamed("node", "cls").join(least, "root").select("cls", "least"), "cls", "left")
        .join(degree, "cls", "left")
        .select("digest", F.coalesce("least", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    placed = scratch.write(placed, "placed")
    scratch.drop("known", "groups", "links", "roots")
    result = ids.join(placed, "digest", "left")
    return result.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def without_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` but for those whose group has a lesser key; a key stays when any of its rows may stay."""
    groups = similar_groups(docs, key, text, **options).filter(F.col(key).isNotNull())
    stays = groups.groupBy(key).agg(F.max(F.col("component_id").eqNullSafe(F.col(key))).alias("stays"))
    dropped = Scratch(docs.sparkSession, "jaccard").write(stays.filter("not stays").select(key), "dropped")
    return docs.join(dropped, key, "left_anti").select(*docs.columns)
