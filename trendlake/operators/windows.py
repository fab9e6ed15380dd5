"""Which strings of a long list a text may hold: the list as bounded bitmaps, looked up at every place of a text.

The bytes of a text have prefix sums of a polynomial hash, so that the hash of any window is a
subtraction, whatever the window's length. A listed string is found by the window of its own
length; places where no string's first three (for long ones eight) bytes begin are not looked at
again. Each length has a bitmap of about ``BITS`` bits a string, two of which a string sets: none
is missed, and a window that is not listed passes seldom. Bitmaps have a greatest size, so a
list of any length takes bounded memory; when it outgrows them, more windows pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

HEADS = (3, 8)
BITS = 32
LEAST, MOST, MOST_LONG = 15, 25, 20  # logarithms of a bitmap's bits; the last one beyond HEADS[-1] bytes
CHUNK = 1 << 20
SLICE = 4 << 20
_FACTOR = 0xD1342543DE82EF95
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256).astype(np.uint64)


@lru_cache(maxsize=2)
def _powers(number: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(number, _FACTOR, np.uint64), np.full(number, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hashes:
    """Hashes of the windows of some bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(1 << max(len(data), 1).bit_length())
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * self.down[starts]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def places(hashes: np.ndarray, log: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a bitmap of 2 ** ``log`` bits."""
    mask = (np.uint64(1) << np.asarray(log).astype(np.uint64)) - np.uint64(1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings and the offset at which each string starts (one more at the end)."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[: len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose ``column`` holds about ``SLICE`` bytes each (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def size_of(number: int, length: int) -> int:
    """Logarithm of the bits of the bitmap for ``number`` strings of one length."""
    return min(max(LEAST, (BITS * number).bit_length()), MOST if length <= HEADS[-1] else MOST_LONG)


def kinds_of(counts: dict[int, int]) -> dict[int, int]:
    """Kind -> logarithm of its bits, given how many strings each length has. A kind is a length, or minus a head's."""
    kinds = {length: size_of(n, length) for length, n in counts.items()}
    for head in HEADS:
        longer = sum(n for length, n in counts.items() if length > head)
        if longer:
            kinds[-head] = size_of(longer, head)
    return kinds


def bits_of(strings: pa.Array, kinds: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(kind, bit) of everything that listed strings set."""
    data, offsets = bytes_of(strings)
    hashes, lengths = Hashes(data), np.diff(offsets)
    kind, bit = [], []
    for head in (None, *HEADS):
        chosen = np.flatnonzero(lengths > (head or 0))
        own = lengths[chosen] if head is None else np.full(len(chosen), -head)
        log = np.array([kinds[k] for k in own.tolist()], np.int64)
        for places_ in places(hashes.of(offsets[chosen], lengths[chosen] if head is None else head), log):
            kind.append(own)
            bit.append(places_)
    return np.concatenate(kind), np.concatenate(bit)


class Listed:
    """The bitmaps of a list, by kind."""

    def __init__(self, kinds: dict[int, int]):
        self.kinds = kinds
        self.maps = {kind: np.zeros(1 << (log - 3), np.uint8) for kind, log in kinds.items()}

    def _passing(self, hashes: Hashes, starts: np.ndarray, kind: int) -> np.ndarray:
        found = hashes.of(starts, abs(kind))
        bits = self.maps[kind]
        first, second = places(found, self.kinds[kind])
        hit = np.flatnonzero(bits[first >> 3] >> (first & 7).astype(np.uint8) & 1)
        second = second[hit]
        return starts[hit[(bits[second >> 3] >> (second & 7).astype(np.uint8) & 1).astype(bool)]]

    def _chunk(self, data: np.ndarray, room: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, starts of the windows that pass) among the first ``len(room)`` bytes."""
        hashes, starts, low = Hashes(data), np.arange(len(room)), 0
        for head in (*HEADS, 0):
            for length in sorted(k for k in self.kinds if k > low and (k <= head or not head)):
                yield length, self._passing(hashes, starts[room[starts] >= length], length)
            if -head not in self.kinds or not head:
                return
            starts, low = self._passing(hashes, starts[room[starts] > head], -head), head

    def find(self, texts: pa.Array, first: int | None = None) -> tuple[np.ndarray, pa.Array]:
        """Offsets of each text's strings and the strings, each once a text: all listed ones that it holds, and few others.

        With ``first`` a string is given for the first texts that hold it only.
        """
        data, offsets = bytes_of(texts)
        rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
        longest = max([0, *self.kinds])
        owners, strings = [np.zeros(0, np.int64)], [pa.array([], pa.binary())]
        for start in range(0, len(data), CHUNK):
            stop = min(start + CHUNK, len(data))
            part, row = data[start : stop + longest], rows[start:stop]
            for length, at in self._chunk(part, offsets[row + 1] - np.arange(start, stop)):
                if not len(at):
                    continue
                own, seen = row[at], part[at[:, None] + np.arange(length)]
                if length <= 4:  # the bytes beside the row make one number
                    key = own << 32
                    for i in range(length):
                        key = key | seen[:, i].astype(np.int64) << 8 * i
                    kept = np.flatnonzero(~pd.Series(key).duplicated().to_numpy())
                    own, seen = own[kept], seen[kept]
                owners.append(own)
                buffer = pa.py_buffer(np.ascontiguousarray(seen))
                bounds = pa.py_buffer(np.arange(0, (len(own) + 1) * length, length, dtype=np.int32))
                strings.append(pa.Array.from_buffers(pa.binary(), len(own), [None, bounds, buffer]))
        owner, coded = np.concatenate(owners), pa.concat_arrays(strings).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = np.sort(pd.unique(owner * max(len(coded.dictionary), 1) + codes))
        owner, codes = np.divmod(pairs, max(len(coded.dictionary), 1))
        if first is not None:
            kept = (pd.Series(codes).groupby(codes).cumcount() < first).to_numpy()
            owner, codes = owner[kept], codes[kept]
        counts = np.bincount(owner, minlength=len(texts))
        return np.concatenate([[0], np.cumsum(counts)]), coded.dictionary.take(pa.array(codes))
