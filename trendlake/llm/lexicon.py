"""Words compiled into a minimal acyclic transducer that yields their token ids.

States with the same continuations are one state, so words share suffixes as well as
prefixes. Every arc carries the number of words that sort before the ones it leads to;
the sum along a word's arcs is the word's rank, and the rank points at its ids. The
whole lexicon is one flat file of little-endian arrays, made to be memory-mapped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa

from trendlake.llm.columnar import ragged, utf8_bytes

MAGIC = 0x4C584B31
ARRAYS = ("arc_keys", "arc_targets", "arc_outputs", "final", "starts", "ids")
TYPES = {"arc_keys": "<i8", "arc_targets": "<i4", "arc_outputs": "<i4", "final": "<u1", "starts": "<i8", "ids": "<i4"}


def compile_lexicon(entries: Mapping[str, Sequence[int]]) -> bytes:
    """The file for ``entries``: word -> ids. Words may be empty or any text; none is lost."""
    words = sorted((word.encode("utf-8"), tuple(ids)) for word, ids in entries.items())
    register: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def frozen(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(nodes)
            nodes.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # of the word being added: is it a word's end, its arcs so far
    last = b""
    for word, _ in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[depth - 1], frozen(final, arcs)))
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        final, arcs = path.pop()
        path[-1][1].append((last[depth - 1], frozen(final, arcs)))
    root = frozen(*path[0])

    below = np.zeros(len(nodes), np.int64)  # words that can be completed from each state
    keys, targets, outputs = [], [], []
    for state, (final, arcs) in enumerate(nodes):  # a state follows those that it leads to
        seen = int(final)
        for symbol, target in arcs:
            keys.append(state << 8 | symbol)
            targets.append(target)
            outputs.append(seen)
            seen += int(below[target])
        below[state] = seen
    arrays = {
        "arc_keys": keys, "arc_targets": targets, "arc_outputs": outputs, "final": [final for final, _ in nodes],
        "starts": np.concatenate([[0], np.cumsum([len(ids) for _, ids in words], dtype=np.int64)]),
        "ids": [i for _, ids in words for i in ids],
    }
    packed = [np.asarray(arrays[name], dtype=TYPES[name]) for name in ARRAYS]
    head = np.array([MAGIC, root, *map(len, packed)], dtype="<i8").tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in packed)


class Lexicon:
    """A compiled lexicon, mapped from its file: processes of one machine share its pages."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        head = raw[: 8 * (2 + len(ARRAYS))].view("<i8")
        if int(head[0]) != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.root, at = int(head[1]), len(head) * 8
        for name, length in zip(ARRAYS, head[2:], strict=True):
            size = int(length) * np.dtype(TYPES[name]).itemsize
            setattr(self, name, raw[at : at + size].view(TYPES[name]))
            at += size + -size % 8

    def ranks(self, words: pa.Array) -> np.ndarray:
        """Rank of each word, -1 where the lexicon lacks it. All words advance one byte at a time."""
        data, offsets = utf8_bytes(words)
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")  # words still being read stay in front
        at, left = offsets[:-1][order], lengths[order]
        state = np.full(len(order), self.root, np.int64)
        rank = np.zeros(len(order), np.int64)
        alive = np.ones(len(order), bool)
        live = len(order)
        for depth in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left[:live], -depth, side="left"))
            moving = np.flatnonzero(alive[:live])
            if not len(moving) or not len(self.arc_keys):
                alive[:live] = False
                break
            key = state[moving] << 8 | data[at[moving] + depth]
            arc = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            found = self.arc_keys[arc] == key
            alive[moving[~found]] = False
            moving, arc = moving[found], arc[found]
            state[moving] = self.arc_targets[arc]
            rank[moving] += self.arc_outputs[arc]
        alive &= self.final[state] == 1
        out = np.empty(len(order), np.int64)
        out[order] = np.where(alive, rank, -1)
        return out

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are known, and for those, one after another, how many ids and the ids."""
        ranks = self.ranks(words)
        known = ranks >= 0
        starts = self.starts[ranks[known]]
        lengths = self.starts[ranks[known] + 1] - starts
        return known, lengths, np.asarray(self.ids[ragged(starts, lengths)])
