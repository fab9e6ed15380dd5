"""Exact quantiles without gathering a column in one task.

The wanted ranks of all columns are closed in together. In each round, one pass sketches
the values still in question and takes quantiles on both sides of every open rank, and one
counts how the values lie to them; a rank falls onto one of them or between two, wherever
the sketch put it. Both ends are then left out, so every round leaves a small part of the
values. What is left of all ranks is ordered in one last pass, once it is at most ``limit``
values for each. Most tables take three passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIMIT = 50_000
ERROR = 0.001


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _ranks(n: int, p: float, interpolate: bool) -> tuple[int, int, float]:
    """Zero-based lower rank, upper rank and the share of the upper one."""
    if interpolate:
        position = (n - 1) * p
        low = math.floor(position)
        return low, min(low + 1, n - 1), position - low
    rank = max(math.ceil(n * p) - 1, 0)
    return rank, rank, 0.0


@dataclass
class Span:
    """An open interval of one column that has the value of some ranks; ``below`` values lie before it."""

    column: str
    low: float | None
    high: float | None
    below: int
    inside: int
    ranks: tuple[int, ...]

    def holds(self, low: float | None = None, high: float | None = None) -> Column:
        """Whether a row's value lies in the span, or in a part of it."""
        value, low, high = _number(self.column), self.low if low is None else low, self.high if high is None else high
        after = value.isNotNull() if low is None else value > low
        return after if high is None else after & (value < high)


def _unpivoted(df: DataFrame, spans: Sequence[Span]) -> DataFrame:
    """(span, v): the values of every span, one row for each."""
    entries = [F.when(s.holds(), F.struct(F.lit(i).alias("span"), _number(s.column).alias("v"))) for i, s in enumerate(spans)]
    inside = reduce(or_, [s.holds() for s in spans])
    return df.filter(inside).select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))


def _sketch_size(error: float) -> int:
    """The size of a sketch whose ranks are off by ``error`` at most, as its authors state it."""
    return min(max(math.ceil((2.296 / error) ** (1 / 0.9021)), 8), 65_535)


def _quantiles(value: Column, shares: Sequence[float], error: float) -> Column:
    """Aggregate: the values at the shares of those that are not null, by a sketch; null without values."""
    sketch = F.kll_sketch_agg_double(value, F.lit(_sketch_size(error)))
    within = [min(max(share, 0.0), 1.0) for share in shares]
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, within))))


def _sides(shares: Sequence[float], error: float) -> list[float]:
    return sorted({min(max(share + side, 0.0), 1.0) for share in shares for side in (-2 * error, 2 * error)})


def _cuts(df: DataFrame, spans: Sequence[Span], error: float) -> list[list[float]]:
    """Values on both sides of the ranks of each span."""
    found = df.agg(*[
        _quantiles(F.when(s.holds(), _number(s.column)), _sides([(r - s.below) / s.inside for r in s.ranks], error), error).alias(f"c{i}")
        for i, s in enumerate(spans)
    ]).first()
    return [found[f"c{i}"] for i in range(len(spans))]


def _narrowed(df: DataFrame, spans: Sequence[Span], cuts: Sequence[Sequence[float]], known: dict) -> list[Span]:
    """The parts of ``spans`` in which their ranks lie; ranks that fall onto a cut are added to ``known``."""
    ends = [sorted(set(c)) for c in cuts]
    counts = df.agg(*[
        column.alias(f"{tag}{i}_{k}")
        for i, values_ in enumerate(ends)
        for k, cut in enumerate([*values_, None])
        for tag, column in _counts(spans[i], values_[k - 1] if k else None, cut)
    ]).first()
    parts = []
    for i, s in enumerate(spans):
        below, low = s.below, s.low
        for k, cut in enumerate([*ends[i], None]):
            inside, same = counts[f"within{i}_{k}"], counts[f"same{i}_{k}"]
            ranks = tuple(r for r in s.ranks if below <= r < below + inside)
            if ranks:
                parts.append(Span(s.column, low, s.high if cut is None else cut, below, inside, ranks))
            below += inside
            known.update({(s.column, r): cut for r in s.ranks if below <= r < below + same})
            below, low = below + same, cut
    return parts


def _counts(span: Span, low: float | None, cut: float | None) -> list[tuple[str, Column]]:
    same = F.lit(0) if cut is None else F.count_if(_number(span.column) == cut)
    return [("within", F.count_if(span.holds(low, cut))), ("same", same)]


def _ordered(df: DataFrame, spans: Sequence[Span], known: dict) -> None:
    """Order the few values of all spans and look their ranks up."""
    order = Window.partitionBy("span").orderBy("v")
    counted = _unpivoted(df, spans).groupBy("span", "v").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(order))
    hit = F.lit(False)
    for i, s in enumerate(spans):
        for r in s.ranks:
            at = r - s.below
            hit = hit | ((F.col("span") == i) & (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at))
    for row in counted.filter(hit).collect():
        s = spans[row["span"]]
        known.update({(s.column, r): row["v"] for r in s.ranks if row["upto"] - row["n"] <= r - s.below < row["upto"]})


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    interpolate: bool = True,
    limit: int = LIMIT,
    error: float = ERROR,
) -> dict[str, list[float | None]]:
    """Exact quantiles per column; a handful of scalars, so they return as Python floats.

    ``interpolate`` picks the continuous definition, otherwise the smallest value
    whose cumulative share reaches the probability. Nulls and NaN do not count.
    """
    sides = _sides(probabilities, error)
    first = df.agg(*[
        a.alias(f"{tag}{i}") for i, c in enumerate(columns) for tag, a in (("n", F.count(_number(c))), ("c", _quantiles(_number(c), sides, error)))
    ]).first()
    known: dict[tuple[str, int], float] = {}
    ready, spans, cuts = [], [], []
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        ranks = {r for p in probabilities for r in _ranks(n, p, interpolate)[:2]} if n else set()
        if ranks:
            span = Span(c, None, None, 0, n, tuple(sorted(ranks)))
            if n <= limit:
                ready.append(span)
            else:
                spans.append(span)
                cuts.append(first[f"c{i}"])
    while spans:
        parts = _narrowed(df, spans, cuts, known)
        ready += [s for s in parts if s.inside <= limit]
        spans = [s for s in parts if s.inside > limit]
        cuts = _cuts(df, spans, error) if spans else []
    if ready:
        _ordered(df, ready, known)

    result: dict[str, list[float | None]] = {}
    for i, name in enumerate(columns):
        n = first[f"n{i}"]
        result[name] = []
        for p in probabilities:
            if not n:
                result[name].append(None)
                continue
            low, high, share = _ranks(n, p, interpolate)
            a, b = known[(name, low)], known[(name, high)]
            result[name].append(a + (b - a) * share)
    return result
