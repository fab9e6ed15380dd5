"""Secrets in text: fixed patterns, and credential values that are hard to guess.

Three patterns find assignments, access keys and long hexadecimal runs. Besides those,
the value that follows a credential word, or the password of a connection string, is measured with
:func:`trendlake.llm.guesses.guess_cost`; one that takes ``10 ** min_cost`` guesses or
more is a secret (kind ``guess``), whatever its alphabet.

Spans are of the whole match for the patterns and of the value for ``guess``, in code
points, end exclusive. Defined results: null and empty text have no spans; equal rows get
equal spans; an empty table gives no rows; only the key and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.columnar import slices, text_column
from trendlake.llm.guesses import RANKS, guess_cost
from trendlake.llm.tables import Scratch

KINDS = ("assign", "access", "hex", "guess")
MIN_COST = 10.0

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# A name anywhere in an identifier, where its last letter is (or with an s) and no small letter follows: dbPassword2, TOKEN_OLD,
# secretKey, but not secretary. "pass" must stand alone. Each identifier is read once, from its first character.
_KEYS = "api|access|private|aws|auth|encryption|signing|master|service|account|client|shared|storage"
_NAME = rf"(?:pass(?:word|wd|phrase|code)|pwd|psk|secret|token|(?:{_KEYS})[_-]?key|credential)s?(?:(?![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))"
CONTEXT = re.compile(
    r"(?ai:(?<![a-z0-9_-])"
    rf"""(?:bearer\s++|authorization["']?\s*+[:=]\s*+["']?basic\s++|(?:(?=[a-z0-9_-]*?(?:{_NAME}|(?<![a-z0-9])(?:pass|bearer)(?![a-z0-9])))[a-z0-9_-]++"""
    r"""["']?\s*+(?:=>|:=|[:=]|(?<=\s)is(?=\s))\s*+)))["']?([^\s"'<>,;]{6,})"""
)
# The password of a connection string, between the user's name and the host.
CONNECTION = re.compile(r"""(?<=://)[^\s:/@"'<>]{1,64}:([^\s/@"'<>]{6,128})@""")
# A text without any of these has no span of any kind.
POSSIBLE = rf"""(?i)pass|pwd|psk|secret|token|({_KEYS})[_-]?key|credential|bearer|authorization|://[^\s:/@"'<>]{{1,64}}:|(?-i:AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}})"""
# A word of a list: small letters between spaces and punctuation, in so many texts; the list ends at so many words.
COMMON = r"(?<![^\s(\"'])\p{L}{3,24}(?=[.,;:!?)\"']*(?:\s|$))"
COMMON_TEXTS, COMMON_SHARE, COMMON_WORDS = 20, 1e-4, 50_000
# What follows a credential's name, with or without a sign between them, is no common word, however many copies a text has.
VALUE = (
    r"""(?i)(?:pass(?:word|wd|phrase|code)?|pwd|psk|secret|token|[_-]key|apikey|credential|bearer|basic)[a-z0-9_-]{0,40}["']?"""
    r"""\s{0,8}(?:=>|:=|[:=]|is(?=\s))?\s{0,8}["']?[^\s"'<>,;]{3,}|://[^\s:/@"'<>]{1,64}:[^\s/@"'<>]{3,128}@"""
)
CLASSES = 8  # of numbers of texts, for each power of two


def common_words(
    docs: DataFrame, text: str = "text", texts: int = COMMON_TEXTS, share: float = COMMON_SHARE, size: int = COMMON_WORDS
) -> dict[str, int]:
    """Ranks of the words that are in most texts; listed words keep a better rank.

    A word is in ``texts`` texts at least and in ``share`` of all; words in the place of a
    credential's value do not count. Counts are put into classes by their logarithm, and the
    highest classes with no more than ``size`` words together are taken whole, so the driver
    gets one number for each class and at most ``size`` words, whatever the number of tasks.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    body = F.when(F.col(text).rlike(VALUE), F.regexp_replace(text, VALUE, "; ")).otherwise(F.col(text))
    own = F.array_distinct(F.regexp_extract_all(F.lower(body), F.lit(COMMON), F.lit(0)))
    least = docs.select(F.greatest(F.lit(texts), F.count("*") * share).alias("least"))
    counted = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least.scalar())
    counted = scratch.write(counted.withColumn("class", F.floor(F.log2("n") * CLASSES).cast("int")), "words")
    lowest, held = None, 0
    for row in sorted(counted.groupBy("class").count().collect(), reverse=True):  # at most 64 classes for each power of two
        held += row["count"]
        if held > size:
            break
        lowest = row["class"]
    rows = [] if lowest is None else counted.filter(F.col("class") >= lowest).select("word", "n").collect()
    scratch.drop("words")
    ranks = {row["word"]: rank for rank, row in enumerate(sorted(rows, key=lambda r: (-r["n"], r["word"])), 1)}
    return ranks | {word: min(rank, ranks.get(word, rank)) for word, rank in RANKS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns. Matches that are too short are used up, then dropped."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def guess_spans(
    text: str, base: list[tuple[int, int, int]], min_cost: float = MIN_COST, words: dict[str, int] | None = None
) -> list[tuple[int, int, int]]:
    """Credential values that are hard to guess and that base spans do not cover from start to end."""
    joined: list[list[int]] = []  # what the base spans cover, in pieces that do not touch
    for start, _, stop in base:
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], stop)
        else:
            joined.append([start, stop])
    out, at = [], 0
    values = sorted([*CONTEXT.finditer(text), *CONNECTION.finditer(text)], key=lambda m: m.start(1))
    last = -1
    for m in values:
        if m.start(1) == last:
            continue
        last = m.start(1)
        while at < len(joined) and joined[at][1] <= m.start(1):
            at += 1
        value = m[1].rstrip(".)]}") if m.re is CONTEXT else m[1]
        end = m.start(1) + len(value)
        covered = at < len(joined) and joined[at][0] <= m.start(1) and end <= joined[at][1]
        if len(value) >= 6 and not covered and guess_cost(value, words, min_cost) >= min_cost:
            out.append((m.start(1), 3, end))
    return out


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_cost: float = MIN_COST, words: dict[str, int] | None = None
) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) of every row. ``words`` has ranks of easy words (else the fixed list)."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    nothing = hashlib.sha256(b"").hexdigest()

    def row(value: str) -> tuple:
        base = base_spans(value)
        counts = [sum(span[1] == kind for span in base) for kind in range(3)]
        everything = base + guess_spans(value, base, min_cost, shared.value)
        return *counts, hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(everything)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = text_column(piece, "text")
                possible = pc.match_substring_regex(texts, POSSIBLE)
                found = iter([row(t) for t in texts.filter(possible).to_pylist()])
                rows = [next(found) if p else (0, 0, 0, nothing, "") for p in possible.to_pylist()]
                columns = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("key"), *arrays], [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
