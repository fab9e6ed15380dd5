"""Byte-pair encoding and decoding with a compiled lexicon of frequent words.

Words are counted over all texts; the most frequent ones are merged once, on the
driver, and compiled with their ids into a minimal acyclic transducer
(:mod:`trendlake.llm.lexicon`). Each executor fetches the file once and its workers map
it. A text is cut into space-separated pieces, each distinct piece of a batch is
normalised and cut into words, known words take their ids from the transducer, and the
others go through the merges themselves, all of a batch together
(:mod:`trendlake.llm.merges`), so that the result never depends on what the lexicon holds.

Defined results: null text is encoded as empty text (no ids); equal rows give equal
results; special tokens written out in a text become their ids; columns of the input
other than the key and the text are not read. Lengths are not limited: a word of any length
costs about as much a letter as sorting its letters, and one of more than ``LEXICON_WORD``
bytes never gets into a lexicon.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trendlake.llm.columnar import Words, map_batches, ragged, text_column
from trendlake.llm.lexicon import Lexicon, compile_lexicon
from trendlake.llm.merges import Merges
from trendlake.llm.tables import Scratch

WORD_BPE = "word_bpe_49k.json"
LEXICON_WORDS = 65_536
LEXICON_WORD = 256  # bytes of the longest word of a lexicon
SLICE = 6 << 20
PIECES = 1 << 15  # different pieces that are cut into words at once
GATHER = 1 << 17  # occurrences of words whose ids are written at once
PLAIN_BELOW = 0x250  # code points that are stable under NFC and whose classes do not differ between Unicode versions


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_BELOW) if unicodedata.category(chr(c))[0] == kind)


class WordBpe:
    """One word-level BPE vocabulary: normalisation, words, merges, ids and tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.path = path
        self.suffix = model["model"]["end_of_word_suffix"] or ""
        self.ids = dict(model["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"])
        self.symbols = byte_symbols()
        self.merges = Merges(self.ids, list(pairs), self.symbols, self.suffix)
        letters, numbers = _class("L"), _class("N")
        space = "".join(re.escape(chr(c)) for c in range(PLAIN_BELOW) if c in (*range(9, 14), 32, 0x85, 0xA0))
        self.words = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
        self.unusual = re.compile(rf"[^\x00-{chr(PLAIN_BELOW - 1)}]")
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    @cached_property
    def library(self) -> Tokenizer:
        """Needed for unusual characters only."""
        return Tokenizer.from_file(self.path)

    def words_of(self, text: str) -> list[str]:
        """Words of a text without special tokens, normalised, in their own characters."""
        low = text.lower()
        if not self.unusual.search(low):
            return self.words.findall(low)
        normal = self.library.normalizer.normalize_str(text)
        return [self._letters(word) for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _letters(self, word: str) -> str:
        back = {symbol: byte for byte, symbol in enumerate(self.symbols)}
        return bytes(back[c] for c in word).decode("utf-8")

    def pieces(self, text: str) -> list[str | int]:
        """Words of a text and, as numbers, the special tokens written in it."""
        if "<|" not in text:
            return self.words_of(text)
        out: list[str | int] = []
        for part in self.split.split(text):
            out.extend([self.special[part]] if part in self.special else self.words_of(part))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def mapped(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def encode_pieces(bpe: WordBpe, lexicon: Lexicon, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each space-free piece has, and all ids."""
    parts = [bpe.pieces(piece) for piece in pieces]
    flat = [part for piece in parts for part in piece]
    is_word = np.fromiter((isinstance(part, str) for part in flat), bool, len(flat))
    coded = pa.array([part for part in flat if isinstance(part, str)], pa.string()).dictionary_encode()
    known, lengths, ids = lexicon.look_up(coded.dictionary)
    extra, new = bpe.merges.words(coded.dictionary.filter(pa.array(~known)))
    store = np.concatenate([ids, new, np.fromiter((p for p in flat if not isinstance(p, str)), np.int64, int((~is_word).sum()))])
    size = np.empty(len(known), np.int64)
    size[known], size[~known] = lengths, extra
    start = np.empty(len(known), np.int64)
    start[known] = np.cumsum(lengths) - lengths
    start[~known] = len(ids) + np.cumsum(extra) - extra
    code = coded.indices.to_numpy(zero_copy_only=False)
    all_sizes = np.ones(len(flat), np.int64)
    all_starts = np.empty(len(flat), np.int64)
    all_sizes[is_word], all_starts[is_word] = size[code], start[code]
    all_starts[~is_word] = len(ids) + int(extra.sum()) + np.arange(int((~is_word).sum()))
    ends = np.concatenate([[0], np.cumsum(all_sizes)])
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return ends[bounds[1:]] - ends[bounds[:-1]], store[ragged(all_starts, all_sizes)]


def encode_texts(bpe: WordBpe, lexicon: Lexicon, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text's ids, and the ids of all texts.

    Python's strings and the ids take much more memory than the text, so both are made a
    part at a time.
    """
    words = Words(texts)
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
    for first in range(0, len(words.distinct), PIECES):
        sizes, ids = encode_pieces(bpe, lexicon, words.distinct.slice(first, PIECES).to_pylist())
        parts.append((sizes, ids.astype(np.int32)))
    lengths, ids = map(np.concatenate, zip(*parts, strict=True))
    starts = np.cumsum(lengths) - lengths
    ends = np.concatenate([[0], np.cumsum(lengths[words.codes])])
    out = np.empty(int(ends[-1]), np.int32)
    for first in range(0, len(words.codes), GATHER):
        codes = words.codes[first : first + GATHER]
        out[ends[first] : ends[first + len(codes)]] = ids[ragged(starts[codes], lengths[codes])]
    return ends[words.offsets], out


def word_counts(docs: DataFrame, text: str, path: str) -> DataFrame:
    """(word, n) over all texts, counted within batches first."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = vocabulary(path)
        words = Words(text_column(batch, text))
        times = np.bincount(words.codes, minlength=len(words.distinct))
        numbers, found = [], [pa.array([], pa.string())]
        for first in range(0, len(words.distinct), PIECES):
            parts = [[p for p in bpe.pieces(x) if isinstance(p, str)] for x in words.distinct.slice(first, PIECES).to_pylist()]
            numbers.extend(map(len, parts))
            found.append(pa.array([p for x in parts for p in x], pa.string()))
        flat = pa.concat_arrays(found).dictionary_encode()
        weight = np.repeat(times, numbers)
        total = np.bincount(flat.indices.to_numpy(zero_copy_only=False), weights=weight, minlength=len(flat.dictionary))
        return pa.RecordBatch.from_arrays([flat.dictionary, pa.array(total.astype(np.int64))], ["word", "n"])

    counted = map_batches(docs.select(text), text, count, "word string, n long", SLICE)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, text: str = "text", path: str | None = None, size: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words, ``size`` at most, and give the file to all executors; its name.

    Counts are put into classes by their logarithm; the highest classes that hold no
    more than ``size`` words together are taken whole, so no sort passes the driver.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path(WORD_BPE)
    bpe = vocabulary(path)
    scratch = Scratch(spark, "bpe")
    counted = word_counts(docs, text, path).withColumn("class", F.floor(F.log2("n") * 8).cast("int"))
    counted = scratch.write(counted, "words")
    lowest, held = None, 0
    for row in sorted(counted.groupBy("class").count().collect(), reverse=True):  # at most 512 rows
        held += row["count"]
        if held > size:
            break
        lowest = row["class"]
    short = counted.filter((F.col("class") >= (0 if lowest is None else lowest)) & (F.octet_length("word") <= LEXICON_WORD))
    frequent = [row.word for row in short.select("word").collect()] if lowest is not None else []
    scratch.drop("words")
    sizes, ids = bpe.merges.words(pa.array(frequent, pa.string()))
    content = compile_lexicon(dict(zip(frequent, np.split(ids, np.cumsum(sizes)[:-1]), strict=True)) if frequent else {})
    name = f"lexicon-{hashlib.sha256(content).hexdigest()[:32]}"
    scratch = Scratch(spark, "bpe", run="lexicons")  # a session may register a file name for one path only
    spark.sparkContext.addFile(scratch.write_file(name, content))
    return name


def encode(docs: DataFrame, lexicon: str, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): the ids of every text."""
    path = path or public_tokenizers.path(WORD_BPE)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, ids = encode_texts(vocabulary(path), mapped(lexicon), text_column(batch, text))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([batch.column(key), lists], [key, "ids"])

    return map_batches(docs.select(key, text), text, run, schema, SLICE)


def digests(docs: DataFrame, lexicon: str, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): every text encoded and decoded from its ids.

    Token ids need not leave the task that makes them when only their digests are wanted.
    """
    path = path or public_tokenizers.path(WORD_BPE)
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = vocabulary(path)
        offsets, ids = encode_texts(bpe, mapped(lexicon), text_column(batch, text))
        ids = ids.astype("<u4", copy=False)
        own = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        columns = [
            batch.column(key), pa.array(np.diff(offsets)),
            pa.array([hashlib.sha256(x).hexdigest() for x in own], pa.string()),
            pa.array([hashlib.sha256(bpe.decode(x).encode("utf-8")).hexdigest() for x in own], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(key, text), text, run, schema, SLICE)


def decode(encoded: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(key, text): the tokens of ``ids`` joined as the vocabulary's library joins them; null ids give null."""
    path = path or public_tokenizers.path(WORD_BPE)
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            lists = batch.column("ids")
            texts = [None if x is None else bpe.decode(np.asarray(x, np.int64)) for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")
