"""Exact Jaccard self-join of a bounded group of sets in memory, skipping by set relations.

* Index level: lists hold only prefix entries, in blocks by position; a probe at
  position ``i`` leaves out every block whose positions cannot belong to a first common
  token of a similar set.
* Answer level: overlaps of a set with all others are derived from those of the set
  handled just before, through the tokens in which the two differ. Sets that are linked
  are handled one after another, so that these are few.
"""

from __future__ import annotations

import numpy as np


def prefix_length(n: np.ndarray | int, percent: int):
    """Tokens of a set of size ``n`` of which a similar set must share one."""
    return n - (-(-n * percent // 100)) + 1


class Group:
    """Sets of one group. ``side`` tells two parts apart: with both present, only links between them count."""

    def __init__(self, sets: list[np.ndarray], side: np.ndarray, percent: int):
        self.percent, self.side, self.size = percent, side, np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[token] > 1  # others make no overlap; they come first in every set's order
        order = np.lexsort((token[shared], count[token][shared], owner[shared]))
        self.tokens, owner = token[shared][order], owner[shared][order]
        self.at = np.searchsorted(owner, np.arange(len(sets) + 1))
        place = np.arange(len(owner)) - self.at[owner] + (self.size - np.diff(self.at))[owner]
        by_token = np.lexsort((place, self.tokens))
        self.listed = owner[by_token]
        self.list_at = np.searchsorted(self.tokens[by_token], np.arange(len(count) + 1))
        first = place < prefix_length(self.size, percent)[owner]
        kept = by_token[first[by_token]]
        self.index_place, self.index_owner = place[kept], owner[kept]
        self.index_at = np.searchsorted(self.tokens[kept], np.arange(len(count) + 1))

    def of(self, x: int) -> np.ndarray:
        return self.tokens[self.at[x] : self.at[x + 1]]

    def promising(self, x: int) -> bool:
        """Whether the index has any set that may be similar to ``x``."""
        n = int(self.size[x])
        offset = n - int(self.at[x + 1] - self.at[x])
        most = (n + n * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)  # of the tokens in which they differ
        for i, token in enumerate(self.of(x)[: max(prefix_length(n, self.percent) - offset, 0)].tolist(), offset):
            start, stop = self.index_at[token], self.index_at[token + 1]
            cut = start + np.searchsorted(self.index_place[start:stop], most - i, side="right")
            near = self.index_owner[start:cut]
            if (near != x).any() and (self.size[near] * 100 >= n * self.percent).any():
                return True
        return False

    def added(self, tokens: np.ndarray) -> np.ndarray:
        """For every set, how many of ``tokens`` it has."""
        lists = [self.listed[self.list_at[t] : self.list_at[t + 1]] for t in tokens.tolist()]
        return np.bincount(np.concatenate(lists) if lists else np.zeros(0, np.int64), minlength=len(self.size))

    def weight(self, tokens: np.ndarray) -> int:
        return int((self.list_at[tokens + 1] - self.list_at[tokens]).sum())

    def join(self, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every set, the least member of its linked group, and the copies of the sets it is linked with."""
        count, cross = len(self.size), len(np.unique(self.side)) > 1
        root, links, seen = np.arange(count), np.zeros(count, np.int64), np.zeros(count, bool)
        known, overlap = -1, np.zeros(count, np.int64)
        for start in range(count):
            stack = [start]
            while stack:
                x = stack.pop()
                if seen[x]:
                    continue
                seen[x] = True
                own = self.of(x)
                near = known >= 0 and root[known] == root[x]  # in one linked group: their answers are alike
                if not near and not self.promising(x):
                    continue
                gone = new = own
                if near:
                    before = self.of(known)
                    gone, new = np.setdiff1d(before, own, assume_unique=True), np.setdiff1d(own, before, assume_unique=True)
                if near and self.weight(gone) + self.weight(new) < self.weight(own):
                    overlap = overlap + self.added(new) - self.added(gone)
                else:
                    overlap = self.added(own)
                known = x
                linked = overlap * (100 + self.percent) >= (self.size + self.size[x]) * self.percent
                linked[x] = False
                if cross:
                    linked &= self.side != self.side[x]
                partners = np.flatnonzero(linked)
                links[x] = copies[partners].sum()
                root[partners] = root[x]
                stack.extend(partners[~seen[partners]].tolist())
        return root, links
