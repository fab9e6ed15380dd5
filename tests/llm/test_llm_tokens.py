import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trendlake.llm import bpe, sequences
from trendlake.llm.lexicon import Lexicon, compile_lexicon

ODD = [
    None, "", " ", "  ", "a  b", "a   b", "a\n b", " a \nb ", "x  ", "don't <|endoftext|>x<|startoftext|> 'S 'LL it's", "Σίσυφος ΟΔΟΣ İstanbul ﬁ Å é ́x",
    "日本 語\n\n\n x\t\ty 123٣ ½ ²", "a \x1c b\x85c\xa0d", "\U0001f600ab", "".join(map(chr, range(1, 0x24F))), "THE the The", "THE the The", "word " * 30_000,
    "z" * 4_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(3, ODD[3], "again"), (None, "no key", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.mark.parametrize("words", [{}, {"": [7]}, {"a": [1], "ab": [2, 3], "b": [], "été": [4], "ab\0": [5]}, {f"{i}ing": [i] for i in range(500)}])
def test_lexicon_gives_every_word_and_no_other(tmp_path, words):
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(words))
    asked = [*words, "a" * 300, "ab\0c", "éte", "ing", "", "499in"]
    known, lengths, ids = Lexicon(str(path)).look_up(pa.array(asked))
    got = iter(np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else [])
    assert [next(got).tolist() if k else None for k in known] == [words.get(w) for w in asked]


def test_merges_equal_the_library():
    library = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    rng = random.Random(4)
    letters = ["abcdefghijklmnopqrstuvwxyz", "aab", "éüßжλ", "etaoinshr"]
    words = sorted({"".join(rng.choice(a) for _ in range(rng.choice([*range(1, 40), 63, 64, 65, 300]))) for a in letters for _ in range(600)})
    counts, ids = bpe.vocabulary(public_tokenizers.path(bpe.WORD_BPE)).merges.words(pa.array(words))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_half_a_million_letters_take_seconds():
    library = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    rng = random.Random(6)
    for word in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(500_000)), "ab" * 250_000):
        started = time.monotonic()
        counts, ids = bpe.vocabulary(public_tokenizers.path(bpe.WORD_BPE)).merges.words(pa.array([word]))
        assert time.monotonic() - started < 10
        assert ids.tolist() == library.encode(word, add_special_tokens=False).ids


def test_lexicon_shares_suffixes(tmp_path):
    few, many = (len(compile_lexicon({f"{c}ization": [1] for c in s})) for s in ("a", "abcdefgh"))
    assert many - few < 8 * 8 * 4


@pytest.mark.parametrize("size", [0, 4, 1_000])
def test_encoding_equals_the_library_whatever_the_lexicon_holds(docs, size):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    name = bpe.build_lexicon(docs, size=size)
    encoded = bpe.encode(docs, name)
    want = {}
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want[row.doc_id] = (ids, library.decode(ids, skip_special_tokens=False))
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {k: v[0] for k, v in want.items()}
    assert {r.doc_id: r.text for r in bpe.decode(encoded).collect()} == {k: v[1] for k, v in want.items()}
    for row in bpe.digests(docs, name).collect():
        ids, text = want[row.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_no_rows(docs):
    none = docs.limit(0)
    assert bpe.encode(none, bpe.build_lexicon(none)).collect() == []
    assert sequences.round_trip(none).collect() == []


def test_files_hold_the_library_ids_in_key_order(docs):
    library = Tokenizer.from_file(public_tokenizers.path(sequences.BYTE_BPE))
    got = sorted(sequences.round_trip(docs, length=64).collect(), key=lambda r: r.start)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start = 0
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for row, made in zip(rows, got, strict=True):
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, sequences.END_ID]
        assert (made.start, made.n_tokens, made.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_sequences_and_masks_are_views_at_known_places(tmp_path):
    encode = sequences.encoder(public_tokenizers.path(sequences.BYTE_BPE))
    texts = pa.array([f"text number {i} of many" for i in range(700)])
    offsets, ids = sequences.with_end(*encode.texts(texts), sequences.END_ID)
    writer = sequences.ShardWriter(str(tmp_path / "part"), encode.dtype, 16, pa.int64())
    for a in range(0, 700, 90):
        b = min(a + 90, 700)
        writer.add(pa.array(range(a, b)), offsets[a : b + 1] - offsets[a], ids[offsets[a] : offsets[b]])
    writer.close()
    shard = sequences.Shard(str(tmp_path / "part"))
    assert len(shard) == -(-len(ids) // 16)
    flat = np.concatenate([shard.sequence(i) for i in range(len(shard))])
    mask = np.concatenate([shard.mask(i).to_numpy(zero_copy_only=False) for i in range(len(shard))])
    assert (flat[: len(ids)] == ids).all() and mask.sum() == len(ids) and mask[: len(ids)].all()
    assert np.shares_memory(shard.sequence(3), shard.flat[0])
    assert not shard.sequence(3).flags.owndata
    assert (np.concatenate(list(shard.ids(2_040, 20))) == ids[2_040:2_060]).all()


def test_strings_and_ids_of_a_batch_are_made_in_parts(monkeypatch):
    path = public_tokenizers.path(bpe.WORD_BPE)
    vocabulary, lexicon, seen = bpe.vocabulary(path), _Nothing(), []
    texts = pa.array([" ".join(f"word{i * j % 997}<|endoftext|>" if i % 9 == 0 else f"été{i * j % 613}," for j in range(50)) for i in range(40)] + [""])
    whole = bpe.encode_texts(vocabulary, lexicon, texts)
    monkeypatch.setattr(bpe, "PIECES", 100)
    monkeypatch.setattr(bpe, "GATHER", 37)
    one = bpe.encode_pieces
    monkeypatch.setattr(bpe, "encode_pieces", lambda *a: (seen.append(len(a[2])), one(*a))[1])
    parts = bpe.encode_texts(vocabulary, lexicon, texts)
    assert max(seen) <= 100 < sum(seen) and parts[1].dtype == np.int32
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    none = bpe.encode_texts(vocabulary, lexicon, pa.array(["", " "]))
    assert none[0].tolist() == [0, 0, 0] and not len(none[1])


class _Nothing:
    """A lexicon without words."""

    def look_up(self, words):
        return np.zeros(len(words), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
