"""How many guesses a value takes: the cheapest segmentation into guessable spans.

Costs are decimal logarithms. A span is a listed word (its rank, and twice as many
guesses for each kind of disguise), a date, a repeated unit, a walk along keyboard rows
or along the alphabet and the digits, or a single character by brute force.
"""

from __future__ import annotations

import re
from math import log10

# Common words of passwords, the most frequent first.
WORDS = (
    "password", "admin", "welcome", "love", "monkey", "dragon", "letmein", "login", "master", "hello", "sunshine", "princess",
    "football", "shadow", "baseball", "superman", "batman", "trustno", "iloveyou", "secret", "pass", "user", "test", "guest", "root",
    "default", "changeme", "example", "sample", "temp", "demo", "server", "database", "token", "key", "summer", "winter", "spring",
    "autumn", "monday", "friday", "january", "march", "april", "august", "october", "december", "the", "and", "for", "you", "with",
    "this", "that", "from", "home", "work", "money", "house", "happy", "star", "blue", "green", "black", "white", "orange", "silver",
    "tiger", "lion", "horse", "flower", "cookie", "coffee", "cheese", "apple", "banana", "michael", "daniel", "thomas", "jordan",
    "jessica", "ashley", "charlie", "andrew", "hunter", "ranger", "soccer", "hockey", "mustang", "computer", "internet", "google",
    "none", "null", "true", "false", "your", "here", "value", "string", "placeholder",
)
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
DISGUISE = str.maketrans("@430$5!17", "aaeossilt")
DATE = re.compile(r"(?a)(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
YEAR = re.compile(r"(?a)(?:19|20)\d\d")
DATE_COST, YEAR_COST = log10(365 * 120), log10(120)

_NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}


def _character(c: str) -> float:
    return log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 95)


_MEASURED: list = [None, []]  # the words of the last call, and their lengths


class _Stretch:
    """Spans that may start and end anywhere inside a stretch: ``n`` units cost ``once + log10(n)``.

    Of two starts, the earlier one, once it is the cheaper, stays so, as ``log10`` flattens:
    starts behind the cheapest are given up, and those before a start with a cheaper way to it.
    """

    def __init__(self, unit: int, least: int) -> None:
        self.unit, self.least, self.since = unit, least, 0
        self.starts: dict[int, list[tuple[int, float]]] = {}  # by their place in the unit

    def broken(self, since: int) -> None:
        """The stretch begins anew."""
        self.since = since
        self.starts.clear()

    def cheapest(self, end: int, best: list[float]) -> float:
        """Cost of the best span that ends here, without ``once``."""
        first = end - self.unit * self.least
        if first < self.since:
            return float("inf")
        starts = self.starts.setdefault(end % self.unit, [])
        while starts and starts[-1][1] >= best[first]:
            starts.pop()
        starts.append((first, best[first]))
        costs = [cost + log10((end - start) // self.unit) for start, cost in starts]
        least = min(costs)
        del starts[costs.index(least) + 1 :]
        return least


def guess_cost(value: str, words: dict[str, int] | None = None, limit: float = float("inf")) -> float:
    """Logarithm of the guesses for ``value``; 0 for an empty one.

    The least cost where that is below ``limit``, else some cost of ``limit`` or more. A unit
    costs 1 a character at least, so no unit longer than ``limit`` is needed; time grows with
    the length times the longest unit and word.
    """
    ranks = words if words is not None else RANKS
    if _MEASURED[0] is not ranks:
        _MEASURED[:] = ranks, sorted({len(word) for word in ranks if word})
    lengths = _MEASURED[1]
    low = value.lower() if len(value.lower()) == len(value) else value
    plain = low.translate(DISGUISE)
    single = [_character(c) for c in value]
    best = [0.0] + [float("inf")] * len(value)

    horizon = 0  # the last place that is reached below the limit

    def reach(end: int, cost: float) -> None:
        nonlocal horizon
        best[end] = min(best[end], cost)
        if cost < limit:
            horizon = max(horizon, end)

    def start(at: int) -> None:
        """Words and dates that begin here."""
        here = best[at]
        for length in lengths:
            if at + length > len(value):
                break
            rank = ranks.get(plain[at : at + length])
            if rank is not None:
                own, small = value[at : at + length], low[at : at + length]
                disguises = (own != small) + (small != plain[at : at + length])
                reach(at + length, here + log10(rank + 1) + disguises * log10(2))
        if at < len(value) and value[at].isdigit():
            if found := DATE.match(value, at):
                reach(found.end(), here + (YEAR_COST if found.end() - at == 4 else DATE_COST))
            if YEAR.match(value, at):
                reach(at + 4, here + YEAR_COST)

    longest = int(min(len(value) // 2, limit))
    repeats = [_Stretch(1, 3), *(_Stretch(unit, 2) for unit in range(2, longest + 1))]
    walks = [(_Stretch(1, 3), step) for step in (1, -1)]
    start(0)
    for end in range(1, len(value) + 1):
        last = end - 1
        if end > horizon + 3 * max(longest, 1):
            return limit  # nothing that began below the limit is still below it
        for stretch in repeats:
            if last >= stretch.unit and value[last] != value[last - stretch.unit]:
                stretch.broken(end - stretch.unit)
            elif (cost := stretch.cheapest(end, best)) < limit:
                reach(end, cost + sum(single[end - stretch.unit : end]))
        for stretch, step in walks:
            if last and (low[last - 1], low[last])[::step] not in _NEXT:
                stretch.broken(last)
            elif (cost := stretch.cheapest(end, best)) < limit:
                reach(end, cost + log10(2 * len(_NEXT)))
        reach(end, best[last] + single[last])
        if best[end] < limit:
            start(end)
    return best[-1]


RANKS = {word: rank for rank, word in enumerate(WORDS, 1)}
