"""Mixing sources to target weights by subset sums over exact text lengths.

Sources, in code-point order with the null source last, weigh 5, 2, 1 and so on in turn
and share ``share`` times the words of all documents; no source gets more than
``max_repeats`` times its own words, and what it cannot take is shared again by weight.
A source first takes all of its documents as often as fits in full. For the rest it
takes the same share of every length, then the longest documents that fit, and a
bounded-knapsack dynamic program over lengths fills the last ``PROGRAM`` words as closely
as the lengths allow. Only counts by length take part in that; which documents of a
length are taken is decided by a seeded hash, with exact ranks only inside the one hash
cell that the boundary falls into.

Words are runs of characters other than space and U+0009 to U+000D.

Defined results: null and empty text have no words, take none and are kept as often as
their source's full rounds; an empty table gives no rows; reruns choose the same rows,
rows with equal key and text being interchangeable. Input columns come back inside
``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm.columnar import WORD_SPACE, slices, text_column, total_by_row, utf8_bytes, with_row
from trendlake.llm.tables import Scratch

WEIGHTS = (5.0, 2.0, 1.0)  # fixed values
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20_240
PROGRAM = 1 << 16
CELLS = 1 << 12

_WORD = np.array([b not in WORD_SPACE for b in range(256)])


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words of each text: bytes of a word that follow a space or start a text."""
    data, offsets = utf8_bytes(texts)
    word = _WORD[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts[heads] = word[heads]
    return total_by_row(starts, offsets)


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """(row, grp, spot, cell, size): the words of every row and its place in the seeded order.

    ``grp`` stands for the source, is never null and sorts as the sources do.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~"))
    spot = F.xxhash64(F.lit(SEED), F.col(key), F.col(text))
    rows, place = with_row(docs, text, carry, grp.alias("grp"), spot.alias("spot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, place):
                size = word_counts(text_column(piece, place))
                columns = [piece.column("row"), piece.column("grp"), piece.column("spot"), pa.array(size.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "grp", "spot", "size"])

    schema = T.StructType([rows.schema[c] for c in ("row", "grp", "spot")]).add("size", "long")
    cell = F.shiftrightunsigned("spot", 64 - (CELLS.bit_length() - 1)).cast("int")
    return rows.mapInArrow(run, schema).withColumn("cell", cell)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(grp, source_size, target) from one row (grp, source_size) for each source.

    With sources in the order of their limit over their weight, those up to some place
    get their limit and the others share what is left by weight. The windows run over
    one row for each source.
    """
    turn = (F.row_number().over(Window.orderBy("grp")) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ordered = Window.orderBy("ratio", "grp")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    here_on = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(max_repeats))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(here_on))
        .withColumn("open", F.when(F.col("level") < F.col("ratio"), F.col("level")))
        .withColumn("common", F.first("open", ignorenulls=True).over(everything))
    )
    target = F.when(F.col("ratio") <= F.coalesce("common", F.col("ratio")), F.col("limit")).otherwise(F.col("weight") * F.col("common"))
    return placed.select("grp", "source_size", target.alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of the ``counts`` documents of each length to take so that their lengths sum up to nearly ``budget``.

    The sum does not exceed the budget. Once what is left fits into the program, it is
    the greatest that the remaining documents can make.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = counts * budget // max(total, 1)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= PROGRAM:
            break
        more = min(int(counts[i] - taken[i]), (left - PROGRAM) // int(lengths[i]) if lengths[i] else 0)
        taken[i] += more
        left -= more * int(lengths[i])
    usable = [i for i in range(len(lengths)) if 0 < lengths[i] <= left and taken[i] < counts[i]]
    # reached[s]: which item first made the sum s; items are lengths times powers of two.
    reached = np.full(left + 1, -1, np.int32)
    reached[0] = 0
    items: list[tuple[int, int]] = [(-1, 0)]
    for i in usable:
        spare, times = min(int(counts[i] - taken[i]), left // int(lengths[i])), 1
        while spare and reached[left] < 0:
            times = min(times, spare)
            step = times * int(lengths[i])
            new = np.flatnonzero((reached[: left + 1 - step] >= 0) & (reached[step:] < 0)) + step
            reached[new] = len(items)
            items.append((i, times))
            spare -= times
            times *= 2
        if reached[left] >= 0:
            break
    best = int(np.flatnonzero(reached >= 0)[-1])
    while best:
        i, times = items[reached[best]]
        taken[i] += times
        best -= times * int(lengths[i])
    return taken


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """One source's rows (grp, size, n, target, source_size): its full rounds and how many to take of each size besides."""
    size, n = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    target, whole = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
    rounds = int(target // whole) if whole else 0
    rest = round(target - rounds * whole)
    order = np.argsort(size, kind="stable")
    picked = np.zeros(len(size), np.int64)
    if rest > 0:
        picked[order] = fit_budget(size[order], np.where(size[order] > 0, n[order], 0), rest)
    return group[["grp", "size", "n", "source_size", "target"]].assign(rounds=rounds, picked=picked)


def choose(small: DataFrame, scratch: Scratch) -> DataFrame:
    """For each source and size: which places of the seeded order are taken once more, and how often all are.

    Places before ``cell``, and in it before ``last``, are taken; of the ``n_last`` rows
    at ``last`` itself, ``quota`` are.
    """
    cells = scratch.write(small.groupBy("grp", "size", "cell").agg(F.count("*").alias("n")), "cells")
    lengths = cells.groupBy("grp", "size").agg(F.sum("n").alias("n"))
    goals = targets(lengths.groupBy("grp").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    schema = "grp string, size long, n long, source_size long, target double, rounds long, picked long"
    plan = scratch.write(lengths.join(goals, "grp").groupBy("grp").applyInPandas(_plan, schema), "plan")
    before = Window.partitionBy("grp", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    open_ = plan.filter("picked > 0").select("grp", "size", "picked")
    bounds = (
        cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(open_, ["grp", "size"])
        .filter("before < picked and picked <= before + n")
        .select("grp", "size", "cell", (F.col("picked") - F.col("before")).alias("need"))
    )
    inside = small.select("grp", "size", "cell", "spot").join(bounds, ["grp", "size", "cell"])
    rank = F.row_number().over(Window.partitionBy("grp", "size").orderBy("spot"))
    inside = scratch.write(inside.withColumn("rank", rank), "inside")
    last = inside.filter("rank = need").select("grp", "size", F.col("spot").alias("last"))
    at_last = inside.join(last, ["grp", "size"]).groupBy("grp", "size").agg(
        F.first("cell").alias("bound"), F.first("last").alias("last"),
        F.count(F.when(F.col("spot") == F.col("last"), 1)).alias("n_last"),
        (F.first("need") - F.count(F.when(F.col("spot") < F.col("last"), 1))).alias("quota"),
    )
    return scratch.write(plan.drop("n", "picked").join(at_last, ["grp", "size"], "left"), "choice")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """(row, size, source_size, target, taken, copies) of every row; the mix has ``copies`` of it."""
    scratch = Scratch(docs.sparkSession, "mixing")
    small = scratch.write(sized(docs, key, text, source, [key]).drop("row"), "sizes")
    choice = choose(small, scratch)
    scratch.drop("sizes", "cells", "plan", "inside")
    joined = sized(docs, key, text, source, carry).join(choice, ["grp", "size"])
    at = (F.col("cell") == F.col("bound")) & (F.col("spot") == F.col("last"))
    sure = (F.col("cell") < F.col("bound")) | ((F.col("cell") == F.col("bound")) & (F.col("spot") < F.col("last")))
    tied = F.coalesce(at & (F.col("n_last") > F.col("quota")), F.lit(False))

    def result(rows: DataFrame, more: Column) -> DataFrame:
        copies = (F.col("rounds") + F.coalesce(more, F.lit(False)).cast("long")).alias("copies")
        return rows.select("row", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies)

    if choice.filter("n_last > quota").isEmpty():
        return result(joined, sure | at)
    # Rows equal in key and text stand at one place: number them in a written table.
    equal = scratch.write(joined.filter(tied).withColumn("mark", F.monotonically_increasing_id()), "tied")
    number = F.row_number().over(Window.partitionBy("grp", "size").orderBy("mark"))
    return result(joined.filter(~tied), sure | at).unionByName(result(equal.withColumn("number", number), F.col("number") <= F.col("quota")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    mixed = mix(docs, key, text, source).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
