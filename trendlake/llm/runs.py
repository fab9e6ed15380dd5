"""Periodic runs of words: maximal repetitions found from seeds on diagonals.

A run of period ``q`` is a stretch of words that agree with the words ``q`` places later,
so it is a stretch of matches on the diagonal of lag ``q``. A run as asked for has
``max(24, 3 q)`` words, so its diagonal holds at least ``max(24 - q, 2 q)`` matches.

1. Lags are taken in bands: 1 to 16 first, then (16, 32], (32, 64], ... The least overlap
   that a run of a band guarantees is at least the band's upper end ``k`` (16 in the first),
   so every run holds a ``k``-gram whose copy lies ``q`` words later. ``k`` is no less than
   ``q``: a copy closer by would give the run a smaller period. So the pairs to look at are
   those of an occurrence with the *next* one in the same text, one for each word and band
   at most, however often a gram occurs.
2. Grams are named exactly, not hashed: the name of a ``2 h``-gram numbers the pair of
   names of its halves. A gram that is alone in its text ends there; no longer gram that
   holds it can repeat.
3. A pair whose lag lies in the band is a seed. It is extended both ways word by word until
   the diagonal's matches end. A table of the furthest place covered on each lag suppresses
   seeds of a stretch that was extended before, so a stretch is read once.

A seed's stretch has at least ``k + q`` words, so by the periodicity lemma ``q`` is its
smallest period, and all stretches of one text together are no longer than its length
times its logarithm. Long texts are as cheap a word as short ones.

Defined results: null text is empty text; a text without words has no run, null run
columns, and the hash of nothing; a null key takes part in no damage (its number is
unknown); repeated rows give repeated results; only key and text are read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.columnar import Words, map_batches, text_column

LEAST_WORDS = 24
LEAST_TIMES = 3
FIRST_GRAM = 16  # the least overlap of a run of period 8: 24 - 8 = 2 * 8


def _repeated(left: np.ndarray, right: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (0, 1, ...) of the pairs (left, right), and which of them occur more than once."""
    _, names, counts = np.unique(left * base + right, return_inverse=True, return_counts=True)
    return names, (counts > 1)[names]


class Diagonals:
    """All runs of a batch of texts. ``codes``: a number for each word; ``offsets``: where texts start."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        self.n = len(codes)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.codes, self.ends = codes, offsets[1:][self.doc] if self.n else offsets[:0]
        self.starts = offsets[:-1][self.doc] if self.n else offsets[:0]

    def _grams(self):
        """(k, places, names) of the grams of 16, 32, ... words that repeat inside their text; places ascend."""
        base = int(self.codes.max()) + 1 if self.n else 1
        at = np.arange(self.n)
        names, again = _repeated(self.doc, self.codes, base)
        at, names, width = at[again], names[again], 1
        while len(at):
            if width >= FIRST_GRAM:
                yield width, at, names
            place = np.searchsorted(at, at + width)
            inside = at + 2 * width <= self.ends[at]
            inside &= at[np.minimum(place, len(at) - 1)] == at + width
            left, right = names[inside], names[place[inside]]
            names, again = _repeated(left, right, int(names.max()) + 1)
            at, names, width = at[inside][again], names[again], 2 * width

    def _matches(self, at: int, lag: int, step: int) -> int:
        """How many words from ``at`` on, in direction ``step``, agree with those ``lag`` places later."""
        if step > 0:
            room, block = int(self.ends[at]) - lag - at, 64
        else:
            room, block = at - int(self.starts[at]) + 1, 64
        done = 0
        while done < room:
            size = min(block, room - done)
            a = at + done if step > 0 else at - done - size + 1
            same = self.codes[a : a + size] == self.codes[a + lag : a + lag + size]
            same = same if step > 0 else same[::-1]
            if not same.all():
                return done + int(np.argmin(same))
            done, block = done + size, block * 2
        return done

    def runs(self) -> np.ndarray:
        """Rows (text, start in the text, length, period), by text, start and period."""
        found = []
        for width, at, names in self._grams():
            order = np.argsort(names, kind="stable")
            first, second = at[order][:-1], at[order][1:]
            lag = second - first
            low = 0 if width == FIRST_GRAM else width // 2
            seed = (names[order][1:] == names[order][:-1]) & (lag > low) & (lag <= width)
            by_place = np.argsort(first[seed], kind="stable")
            covered: dict[int, int] = {}  # lag -> the furthest place on its diagonal that an extension has read
            for i, q in zip(first[seed][by_place].tolist(), lag[seed][by_place].tolist(), strict=True):
                if i < covered.get(q, 0):
                    continue
                end = i + self._matches(i, q, 1)
                start = i - self._matches(i - 1, q, -1) if i > self.starts[i] else i
                covered[q] = end
                length = end - start + q
                if length >= max(LEAST_WORDS, LEAST_TIMES * q):
                    found.append((int(self.doc[i]), start - int(self.starts[i]), length, q))
        return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def damaged(words: Words, keys: list[int | None]) -> np.ndarray:
    """The word codes of a batch after planting repetitions in texts whose key's checksum ends in 0."""
    codes = words.codes.copy()
    counts = words.counts().tolist()
    for start, n, key in zip(words.offsets[:-1].tolist(), counts, keys, strict=True):
        if key is None or not n:
            continue
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            codes[start + a : start + n] = words.codes[start + a + np.arange(n - a) % p]
    return codes


def collapsed(words: Words, codes: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text's words joined by one space, without those that a run has after its first period."""
    change = np.zeros(len(codes) + 1, np.int64)
    first = words.offsets[runs[:, 0]] + runs[:, 1]
    np.add.at(change, first + runs[:, 3], 1)
    np.add.at(change, first + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[words.offsets]
    kept_words = words.distinct.cast(pa.large_string()).take(pa.array(codes[kept]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), kept_words), pa.scalar(" ", pa.large_string()))


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: bool = False) -> DataFrame:
    """(key, runs, collapsed) of every row: its runs as (start, length, period), and the text without them."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, codes, runs = _batch_runs(batch, damage)
        counts = np.bincount(runs[:, 0], minlength=batch.num_rows)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
        columns = [batch.column("key"), pa.ListArray.from_arrays(pa.array(ends), rows), collapsed(words, codes, runs).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, [key, "runs", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", work, schema)


def _batch_runs(batch: pa.RecordBatch, damage: bool) -> tuple[Words, np.ndarray, np.ndarray]:
    words = Words(text_column(batch, "text"))
    codes = damaged(words, batch.column("key").to_pylist()) if damage else words.codes
    return words, codes, Diagonals(codes, words.offsets).runs()


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: bool = True) -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row.

    The one run shown is that of the greatest length over period, then the first.
    """
    best_columns = ("start", "length", "period", "exponent_milli")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, codes, runs = _batch_runs(batch, damage)
        bounds = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1)).tolist()
        best: dict[str, list] = {c: [] for c in best_columns}
        listed = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = runs[a:b, 1:].tolist()
            listed.append(_hex("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()))
            top = None
            for run in own:  # ascending starts and periods: only a greater exponent replaces
                if top is None or run[1] * top[2] > top[1] * run[2]:
                    top = run
            shown = [*top, 1000 * top[1] // top[2]] if top else [None] * 4
            for name, value in zip(best_columns, shown, strict=True):
                best[name].append(value)
        rest = [_hex(t.as_buffer()) for t in collapsed(words, codes, runs)]
        columns = [batch.column("key"), pa.array(np.diff(bounds), pa.int64()), *(pa.array(v, pa.int64()) for v in best.values())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(listed), pa.array(rest)], [key, "n_runs", *best, "runs_sha256", "collapsed_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_runs long, {', '.join(f'{c} long' for c in best_columns)}, runs_sha256 string, collapsed_sha256 string"
    return map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", work, schema)
