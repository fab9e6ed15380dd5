"""Token ids in Arrow stream files: equal-length sequences with masks, read without copying.

A dataset is a folder of shards, one for each range of document keys, in key order.
``part-N.tokens`` is an Arrow stream whose batches hold two fixed-size-list columns:
``ids`` (16 or 32 bits each, by vocabulary size) and ``mask`` (true for real ids; only a
shard's last sequence has padding). ``part-N.docs`` lists the shard's documents with the
place of their first id. A reader maps a file, walks its batch headers once, and then
reaches any sequence, mask or document at a known address.

Tasks write to a name of their own and rename, so a task that is run again leaves the
same file. Shards are written through ``pyarrow.fs``; the folder must be one that every
executor reaches.

Defined results: null text is empty text, which has the end id alone; rows with one key
are ordered by their text's hash, and equal rows count once each; a null key comes first; an
empty table gives no shards; other columns are not read. Texts of any length are taken
whole and may span sequences.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendlake.llm.bpe import byte_symbols
from trendlake.llm.columnar import ragged, slices, text_column, total_by_row, utf8_bytes
from trendlake.llm.merges import Merges
from trendlake.llm.tables import Scratch

BYTE_BPE = "byte_bpe_50k.json"
END_ID = 2
LENGTH = 2048
SEQUENCES_PER_BATCH = 128
SLICE = 8 << 20  # larger pieces of a batch have fewer different words to encode
PLAIN_BELOW = 0x250  # code points whose classes do not differ between Unicode versions


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file of a shared store."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class PieceEncoder:
    """The library's encoding of whole texts, made of the encodings of their distinct words.

    A word boundary of byte-level BPE lies before every space that follows a visible
    character. Texts are cut there into pieces; distinct pieces of letters, digits and signs
    below ``PLAIN_BELOW`` are cut into words by the classes of their characters, and the
    distinct words of a batch are merged together (:mod:`trendlake.llm.merges`). Pieces with
    an apostrophe, a special token or other characters are left to the library, and so is a
    whole text with a space elsewhere. Nothing is remembered from one batch to the next.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        self.merges = Merges(model["model"]["vocab"], pairs, byte_symbols(), "")
        self.special = [t["content"] for t in model["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")

    def _whole(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of strings, by the library."""
        made = [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        return np.fromiter(map(len, made), np.int64, len(made)), np.concatenate([np.zeros(0, self.dtype), *made])

    def pieces(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of pieces: a space or none, then characters without a space."""
        classes, bounds = character_classes(strings)
        odd = total_by_row(classes == ODD, bounds) > 0
        for token in self.special:
            odd |= pc.match_substring(strings, token).to_numpy(zero_copy_only=False)
        plain = ~np.repeat(odd, np.diff(bounds))
        start = np.ones(len(classes), bool)
        start[1:] = (classes[1:] != classes[:-1]) & (classes[:-1] != SPACE)
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        words = np.flatnonzero(start & plain)
        # Characters of plain pieces have one byte below 128 and two above.
        kept = strings.filter(pa.array(~odd))
        data, _ = utf8_bytes(kept)
        lead = (data & 0xC0) != 0x80
        places = np.append(np.flatnonzero(lead), len(data))
        order = np.cumsum(plain) - 1
        cuts = np.append(places[order[words]], len(data)).astype(np.int32)
        text = pa.StringArray.from_buffers(len(words), pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data)))
        coded = text.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        counts, ids = self.merges.words(coded.dictionary)
        starts = np.cumsum(counts) - counts
        sizes = counts[code] if len(code) else np.zeros(0, np.int64)
        flat = ids.astype(self.dtype)[ragged(starts[code], sizes)] if len(code) else ids.astype(self.dtype)
        owner = np.searchsorted(bounds, words, side="right") - 1
        lengths = np.bincount(owner, weights=sizes, minlength=len(strings)).astype(np.int64)
        odd_at = np.flatnonzero(odd)
        odd_lengths, odd_ids = self._whole(strings.filter(pa.array(odd)).to_pylist())
        first = np.cumsum(lengths) - lengths
        first[odd_at] = len(flat) + np.cumsum(odd_lengths) - odd_lengths
        lengths[odd_at] = odd_lengths
        return lengths, np.concatenate([flat, odd_ids])[ragged(first, lengths)]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and the ids of all texts."""
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        open_end = ends_open(coded.dictionary)[code]
        open_end[at[1:] - 1] = False
        whole = total_by_row(open_end, at) > 0

        first = np.zeros(len(code), np.int64)
        first[at[:-1]] = 1
        key = code * 2 + first
        plain = np.repeat(~whole, np.diff(at))
        used = np.zeros(2 * len(coded.dictionary), bool)
        used[key[plain]] = True
        wanted = np.flatnonzero(used)
        spaces = pa.DictionaryArray.from_arrays(pa.array(wanted & 1), pa.array([" ", ""])).cast(pa.string())
        length, flat = self.pieces(pc.binary_join_element_wise(spaces, coded.dictionary.take(pa.array(wanted >> 1)), ""))
        whole_length, whole_ids = self._whole(texts.filter(pa.array(whole)).to_pylist())
        length, flat = np.concatenate([length, whole_length]), np.concatenate([flat, whole_ids])
        start = np.cumsum(length) - length
        place = np.zeros(2 * len(coded.dictionary), np.int64)
        place[wanted] = np.arange(len(wanted))
        take = place[key]
        take[at[:-1][whole]] = len(wanted) + np.arange(len(whole_length))
        alone = plain.copy()
        alone[at[:-1][whole]] = True
        sizes = np.where(alone, length[take], 0) if len(length) else np.zeros(len(take), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ends[at], flat[ragged(start[take], sizes)] if len(length) else flat


def _class_table() -> np.ndarray:
    """The class of every code point below ``PLAIN_BELOW``, and of all others at the end."""
    table = np.full(PLAIN_BELOW + 1, ODD, np.uint8)
    for c in range(0x21, PLAIN_BELOW):
        if not 0x7F <= c <= 0xA0 and chr(c) != "'":
            table[c] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], SIGN)
    table[0x20] = SPACE
    return table


SPACE, LETTER, NUMBER, SIGN, ODD = range(5)
CLASSES = _class_table()


def character_classes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The class of every character, and the characters at which strings start (one more at the end)."""
    data, _ = utf8_bytes(strings)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lengths = pc.utf8_length(strings).to_numpy(zero_copy_only=False)
    return CLASSES[np.minimum(points, PLAIN_BELOW)], np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)


def ends_open(strings: pa.Array) -> np.ndarray:
    """Whether a string is empty or ends in white space."""
    data, offsets = utf8_bytes(strings)
    last = np.append(data, np.uint8(0))[np.maximum(offsets[1:] - 1, 0)] if len(strings) else np.zeros(0, np.uint8)
    doubtful = np.flatnonzero((offsets[1:] == offsets[:-1]) | (last < 0x21) | (last > 0x7E))
    out = np.zeros(len(strings), bool)
    out[doubtful] = [not s or s[-1].isspace() for s in strings.take(pa.array(doubtful)).to_pylist()]
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each with the end id appended."""
    return offsets + np.arange(len(offsets)), np.insert(ids, offsets[1:], end_id)


class ShardWriter:
    """Writes one shard; holds one batch of ids at most besides what it is given."""

    def __init__(self, base: str, dtype: np.dtype, length: int, key_type: pa.DataType):
        self.system, self.path = store(base)
        self.system.create_dir(os.path.dirname(self.path), recursive=True)
        self.length, self.full = length, length * SEQUENCES_PER_BATCH
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("key", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.own = f"{self.path}.{TaskContext.get().taskAttemptId()}" if TaskContext.get() else f"{self.path}.new"
        self.files = {kind: self.system.open_output_stream(f"{self.own}.{kind}") for kind in ("tokens", "docs")}
        self.tokens = pa.ipc.new_stream(self.files["tokens"], self.schema)
        self.docs = pa.ipc.new_stream(self.files["docs"], self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def add(self, keys: pa.Array, offsets: np.ndarray, ids: np.ndarray) -> None:
        columns = [keys, pa.array(offsets[:-1] + self.n_tokens), pa.array(np.diff(offsets))]
        self.docs.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.docs_schema))
        self.n_docs += len(keys)
        self.n_tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.full:
            flat = np.concatenate(self.held)
            cut = len(flat) - len(flat) % self.full
            for start in range(0, cut, self.full):
                self._batch(flat[start : start + self.full], self.full)
            self.held, self.n_held = [flat[cut:].copy()], len(flat) - cut

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.tokens.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            self._batch(np.pad(flat, (0, -len(flat) % self.length)), len(flat))
        for kind, writer in (("tokens", self.tokens), ("docs", self.docs)):
            writer.close()
            self.files[kind].close()
            self.system.move(f"{self.own}.{kind}", f"{self.path}.{kind}")


def _batches(path: str) -> list[pa.RecordBatch]:
    system, place = store(path)
    source = pa.memory_map(place) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(place)
    with pa.ipc.open_stream(source) as reader:
        return list(reader)


class Shard:
    """Random access to one shard. Sequences and masks are views of the mapped file."""

    def __init__(self, base: str):
        self.batches = _batches(f"{base}.tokens")
        self.flat = [b.column("ids").flatten().to_numpy() for b in self.batches]
        self.starts = np.concatenate([[0], np.cumsum([len(f) for f in self.flat], dtype=np.int64)]).astype(np.int64)
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 0
        self.docs = _batches(f"{base}.docs")

    def __len__(self) -> int:
        return int(self.starts[-1]) // self.length if self.length else 0

    def sequence(self, i: int) -> np.ndarray:
        batch = int(np.searchsorted(self.starts, i * self.length, side="right")) - 1
        at = i * self.length - int(self.starts[batch])
        return self.flat[batch][at : at + self.length]

    def mask(self, i: int) -> pa.Array:
        batch = int(np.searchsorted(self.starts, i * self.length, side="right")) - 1
        at = i * self.length - int(self.starts[batch])
        return self.batches[batch].column("mask").flatten().slice(at, self.length)

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of one batch after another."""
        batch = int(np.searchsorted(self.starts, start, side="right")) - 1
        while count > 0:
            at = start - int(self.starts[batch])
            view = self.flat[batch][at : at + count]
            yield view
            start, count, batch = start + len(view), count - len(view), batch + 1


def write_sequences(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None,
    end_id: int = END_ID, length: int = LENGTH,
) -> DataFrame:
    """Encode every text, append ``end_id`` and write the shards; a lazy table of them.

    Its rows are (shard, base, n_docs, n_tokens); running it writes the files.
    """
    path = path or public_tokenizers.path(BYTE_BPE)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId() if task else 0
        base, writer = f"{folder}/part-{shard:06d}", None
        encode = encoder(path)
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                writer = writer or ShardWriter(base, encode.dtype, length, batch.schema.field("key").type)
                writer.add(piece.column("key"), *with_end(*encode.texts(text_column(piece, "text")), end_id))
        if writer:
            writer.close()
            columns = [pa.array([shard]), pa.array([base]), pa.array([writer.n_docs]), pa.array([writer.n_tokens])]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "base", "n_docs", "n_tokens"])

    return rows.select("key", "text").mapInArrow(run, "shard long, base string, n_docs long, n_tokens long")


def read_documents(shards: DataFrame, key: str = "doc_id", key_type: str = "long") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, read from the files.

    ``start`` counts the ids of all documents before it. The running total over shards
    is a window over one row for each shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("shard", "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["base"])
                for docs in shard.docs:
                    starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    crcs = []
                    for start, count in zip(starts.tolist(), counts.tolist(), strict=True):
                        crc = 0
                        for view in shard.ids(start, count):
                            crc = zlib.crc32(view.astype("<u4"), crc)
                        crcs.append(crc)
                    columns = [docs.column("key"), pa.array(starts + row["first"]), pa.array(counts), pa.array(crcs, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, [key, "start", "n_tokens", "ids_crc32"])

    spread = placed.repartition(max(1, shards.count()))
    return spread.mapInArrow(run, f"`{key}` {key_type}, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write all documents and read them back."""
    scratch = Scratch(docs.sparkSession, "sequences")
    shards = scratch.write(write_sequences(docs, scratch.path("shards"), key, text, **options), "manifest")
    return read_documents(shards, key, docs.schema[key].dataType.simpleString())
