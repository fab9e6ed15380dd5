"""Byte-pair merges of many words at once, and of one word of any length.

Words of up to ``LONGEST`` bytes lie in the rows of a matrix, by width; in each step every
row joins its best-ranked pair, the first of equals, and only the two pairs beside it are
looked up again. Longer words use a heap of pairs over a linked list: their cost is that of
sorting, so a word of a megabyte takes seconds.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa

from trendlake.llm.columnar import ragged, utf8_bytes

WIDTHS = (6, 8, 10, 12, 16, 24, 32, 64)
LONGEST = WIDTHS[-1]
ROWS = 8_192  # words of one matrix


class Merges:
    """The merges of one vocabulary: ``ids`` of tokens, ``pairs`` by rank, ``symbols`` of bytes, ``suffix`` of a word's last one."""

    def __init__(self, ids: dict[str, int], pairs: list[tuple[str, str]], symbols: list[str], suffix: str):
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.final = np.array([ids[s + suffix] for s in symbols], np.int64)
        self.base, self.none = max(ids.values()) + 1, len(pairs)
        self.made = np.array([ids[a + b] for a, b in pairs] + [-1], np.int64)
        keys = np.array([ids[a] * self.base + ids[b] for a, b in pairs], np.int64)
        self.table = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.keys = np.append(keys, -1)
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.slots, left = [], np.arange(len(keys))  # each table holds one rank a slot; the others go to the next one
        while len(left):
            slots = np.full(1 << self.bits, self.none, np.int32)
            slots[self._slot(keys[left], len(self.slots))] = left
            self.slots.append(slots)
            left = left[slots[self._slot(keys[left], len(self.slots) - 1)] != left]

    def _slot(self, keys: np.ndarray, table: int) -> np.ndarray:
        factor = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * table & (1 << 64) - 1)
        return (keys.astype(np.uint64) * factor) >> np.uint64(64 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; ``none`` where nothing joins it or an id is negative."""
        keys = left.astype(np.int64) * self.base + right
        found = self.slots[0][self._slot(keys, 0)]
        found[self.keys[found] != keys] = self.none
        for table in range(1, len(self.slots)):
            again = np.nonzero(found == self.none)
            rank = self.slots[table][self._slot(keys[again], table)]
            hit = self.keys[rank] == keys[again]
            found[tuple(x[hit] for x in again)] = rank[hit]
        found[right < 0] = self.none
        return found

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word (of one byte at least) has, and all ids."""
        data, offsets = utf8_bytes(words)
        lengths = np.diff(offsets)
        counts, parts, places = np.zeros(len(lengths), np.int64), [], []
        low = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width))
            for start in range(0, len(chosen), ROWS):
                own = chosen[start : start + ROWS]
                for rows, ids, n in self._matrix(data, offsets[own], lengths[own], width):
                    counts[own[rows]] = n
                    parts.append(ids)
                    places.append(own[rows])
            low = width
        for i in np.flatnonzero(lengths > LONGEST).tolist():
            ids = self.single(data[offsets[i] : offsets[i + 1]])
            counts[i] = len(ids)
            parts.append(ids)
            places.append(np.array([i]))
        ends = np.cumsum(counts)
        flat = np.empty(int(counts.sum()), np.int64)
        for at, ids in zip(places, parts, strict=True):
            flat[ragged(ends[at] - counts[at], counts[at])] = ids
        return counts, flat

    def _matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int):
        """(rows, their ids one after another, number of ids of each) as the rows of one matrix are done."""
        columns = np.arange(width + 1)  # the last one stays free
        inside = columns < lengths[:, None]
        ids = np.full((len(lengths), width + 1), -1, np.int32)
        ids[inside] = self.inner[data[ragged(starts, lengths)]]
        ids[np.arange(len(lengths)), lengths - 1] = self.final[data[starts + lengths - 1]]
        ranks = np.full((len(lengths), width + 1), self.none, np.int32)
        ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        rows, n = np.arange(len(lengths)), lengths.copy()
        while len(rows):
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            live = best < self.none
            if not live.all():
                done = ~live
                out = ids[done]
                yield rows[done], out[out >= 0].astype(np.int64), n[done]
                rows, n, ids, ranks, at, best = rows[live], n[live], ids[live], ranks[live], at[live], best[live]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            n -= 1
            source = columns + (columns > at[:, None])
            source[:, -1] = width
            source += every[:, None] * (width + 1)
            ids, ranks = ids.ravel()[source], ranks.ravel()[source]
            ids[every, at] = self.made[best]
            ranks[every, at] = self.ranks(ids[every, at], ids[every, at + 1])
            inner = np.flatnonzero(at)
            ranks[inner, at[inner] - 1] = self.ranks(ids[inner, at[inner] - 1], ids[inner, at[inner]])

    def single(self, data: np.ndarray) -> np.ndarray:
        """Ids of one word given by its bytes."""
        n, base, table = len(data), self.base, self.table
        ids = self.inner[data].tolist()
        ids[-1] = int(self.final[data[-1]])
        made = self.made.tolist()
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank, i) for i, rank in enumerate(map(table.get, (np.array(ids[:-1]) * base + np.array(ids[1:])).tolist())) if rank is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or table.get(ids[i] * base + ids[j]) != rank:
                continue  # one of the two has been joined with another meanwhile
            ids[i], ids[j] = made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                new = table.get(ids[i] * base + ids[after[i]])
                if new is not None:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0:
                new = table.get(ids[before[i]] * base + ids[i])
                if new is not None:
                    heapq.heappush(heap, (new, before[i]))
        out = np.array(ids, np.int64)
        return out[out >= 0]
