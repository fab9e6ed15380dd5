"""Quality rules of documents and of the hosts they come from.

Each text is judged by its own counts. Failures are then added up by host, and each
host's failure rate is shrunk towards the rate of all hosts with a beta prior whose two
parameters are fitted to the hosts' rates by their moments. Documents of a host whose
shrunk rate exceeds ``max_rate`` are rejected with it.

Words are runs of characters other than space and U+0009 to U+000D.

Defined results: null and empty text have no words and fail; a null host is no host and
gets no verdict; equal rows are judged alike and each counts for its host; an empty
table gives no rows. Input columns come back inside ``row`` and so cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.llm.columnar import WORD_SPACE, Words, slices, text_column, total_by_row, utf8_bytes, window_hashes, with_row
from trendlake.llm.tables import Scratch

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
SYMBOLS = frozenset(b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_LETTER = np.array([(b & 0xC0) != 0x80 and b not in WORD_SPACE for b in range(256)])  # first byte of a code point in a word
_SYMBOL = np.array([b in SYMBOLS for b in range(256)])


def _repeated(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which entries have an equal value of the same owner elsewhere."""
    order = np.lexsort((values, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (values[order][1:] == values[order][:-1])
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeat_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in it."""
    hashes, ends = window_hashes(words.hashes(), words.offsets, 3)
    windows = np.diff(ends)
    again = _repeated(np.repeat(np.arange(len(windows)), windows), hashes)
    covered = np.zeros(len(words.codes) + 3, bool)
    at = np.flatnonzero(again)
    at = at - np.repeat(ends[:-1], windows)[at] + np.repeat(words.offsets[:-1], windows)[at]
    for step in range(3):
        covered[at + step] = True
    return total_by_row(covered[: len(words.codes)], words.offsets)


def repeat_lines(texts: pa.Array) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line."""
    lines = pc.split_pattern(texts, "\n")
    at = lines.offsets.to_numpy().astype(np.int64)
    at -= at[0]
    coded = lines.flatten().dictionary_encode()
    data, starts = utf8_bytes(coded.dictionary)
    real = total_by_row(_LETTER[data], starts) > 0
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    keep = real[code]
    key = np.sort(owner[keep] * len(coded.dictionary) + code[keep])
    later = key[1:][key[1:] == key[:-1]] // max(1, len(coded.dictionary))
    return np.bincount(later, minlength=len(texts))


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = utf8_bytes(texts)
    words = Words(texts)
    return {
        "n_words": words.counts(), "word_chars": total_by_row(_LETTER[data], offsets),
        "n_symbols": total_by_row(_SYMBOL[data], offsets), "n_dup_lines": repeat_lines(texts), "n_repeat_words": repeat_words(words),
    }


def counted(docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None) -> DataFrame:
    """(row, host, the counts, base_failed) of every row; ``row`` has the columns in ``carry`` (all)."""
    rows, place = with_row(docs, text, carry, F.col(host).cast("string").alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, place):
                counts = text_counts(text_column(piece, place))
                failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
                columns = [piece.column("row"), piece.column("host"), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(failed)], ["row", "host", *COUNTS, "base_failed"])

    schema = T.StructType([rows.schema["row"], rows.schema["host"]])
    for name in COUNTS:
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema.add("base_failed", "boolean"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Alpha and beta of the hosts' failure rates, by their mean and their variance beyond chance."""
    total = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("*").alias("hosts")).first()
    if not total.n or not 0 < total.failed < total.n:
        return (1.0, 1.0) if not total.n else (total.failed / total.n + 0.5, 1.5 - total.failed / total.n)
    mean = total.failed / total.n
    off = F.pow(F.col("failed") / F.col("n") - mean, 2)
    squares = hosts.agg(F.sum(F.col("n") * off).alias("s")).first().s / total.n
    chance = mean * (1 - mean) * total.hosts / total.n
    spread = max(squares - chance, mean * (1 - mean) * 1e-4)
    weight = max(mean * (1 - mean) / spread - 1, 1.0)
    return mean * weight, (1 - mean) * weight


def host_verdicts(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, failed, rate, rejected), written: one row for each host."""
    return _verdicts(counted(docs, text, host, []), max_rate)


def _verdicts(each: DataFrame, max_rate: float) -> DataFrame:
    """:func:`host_verdicts` of rows that are counted."""
    tally = each.filter("host is not null").groupBy("host")
    scratch = Scratch(each.sparkSession, "quality")
    hosts = scratch.write(tally.agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "tally")
    alpha, beta = beta_prior(hosts)
    rated = hosts.withColumn("rate", (F.col("failed") + alpha) / (F.col("n") + (alpha + beta)))
    return scratch.write(rated.withColumn("rejected", F.col("rate") > max_rate), "hosts")


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None, max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """:func:`counted` and ``kept``: false for a text that fails and for every text of a rejected host.

    Texts are counted once; what is counted, with the carried columns, is written, and the
    hosts' tally and the result both read it.
    """
    each = Scratch(docs.sparkSession, "quality").write(counted(docs, text, host, carry), "counted")
    rejected = _verdicts(each, max_rate).filter("rejected").select("host", "rejected")
    judged = each.join(rejected, "host", "left")
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull()).drop("rejected")
