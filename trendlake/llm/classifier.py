"""Quality classifier: logistic regression on hashed word n-grams, fitted with FTRL updates.

Features are the words, the pairs of neighbouring words, and the same for the words'
shapes (runs of capitals, small letters and digits as one sign each; a word that repeats
the one before has a sign of its own), hashed into ``2 ** BITS`` weights. A text's value
for a feature is its share of all n-grams times ``SCALE``, so a score is one sparse dot
product, computed for a whole batch at once.

Fitting takes at most ``SAMPLE`` labelled rows, chosen by a seeded hash of the key, in
``SHARDS`` groups. Each group runs the follow-the-regularised-leader updates over its rows
for ``EPOCHS`` rounds; the groups' weights are averaged.

Defined results: null and empty text have no features and score the intercept; rows with
a null or absent label or a null key are not learned from; without any label all scores are
0.5; an empty table gives no rows; only the key and the text are read for a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.columnar import Words, chained, hash_strings, mixed, slices, text_column, window_hashes

BITS = 18
SCALE = 20.0
SAMPLE = 24_000
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
SEED = 907
THRESHOLD = 0.3
FOLDS = 5

_RUNS = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([^\W\d_]+)|(\d+)|(.)\4*", re.DOTALL)
_KINDS = {1: "X", 2: "x", 3: "0"}


def shape(word: str) -> str:
    return "".join(_KINDS.get(m.lastindex, m[0][:2]) for m in _RUNS.finditer(word))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text's features, and the features: an index for each n-gram occurrence."""
    words = Words(texts)
    own = words.hashes()
    shapes = hash_strings(pa.array([shape(w) for w in words.distinct.to_pylist()], pa.string()))
    form = shapes[words.codes] if len(words.codes) else own
    same = np.zeros(len(own), bool)
    same[1:] = own[1:] == own[:-1]
    starts = words.offsets[:-1][np.diff(words.offsets) > 0]
    same[starts] = False
    form = np.where(same, mixed(form + np.uint64(1)), form)
    parts = []
    for salt, values in enumerate((own, form)):
        tag = np.full(len(values), salt, np.uint64)
        parts.append((words.offsets, chained(tag, values)))
        pairs, ends = window_hashes(values, words.offsets, 2)
        parts.append((ends, chained(np.full(len(pairs), salt + 2, np.uint64), pairs)))
    counts = np.stack([np.diff(ends) for ends, _ in parts])
    owner = np.concatenate([np.repeat(np.arange(len(texts)), c) for c in counts])
    index = (np.concatenate([values for _, values in parts]) >> np.uint64(64 - BITS)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return np.concatenate([[0], np.cumsum(counts.sum(axis=0))]), index[order]


def scores(weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Probability of label 1 for each text; the last weight is the intercept."""
    offsets, index = features(texts)
    sums = np.concatenate([[0.0], np.cumsum(weights[index])])
    n = np.diff(offsets)
    linear = (sums[offsets[1:]] - sums[offsets[:-1]]) * SCALE / np.maximum(n, 1)
    return 1 / (1 + np.exp(-(linear + weights[-1]).clip(-35, 35)))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z = self.z[index]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[index])) / ALPHA + L2)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        own = self.weights(index)
        gradient = (1 / (1 + np.exp(-float(np.clip(own @ value, -35, 35)))) - label) * value
        step = (np.sqrt(self.n[index] + gradient**2) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += gradient - step * own
        self.n[index] += gradient**2


def fit_rows(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learned from rows in the order given."""
    offsets, index = features(texts)
    rows = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own, count = np.unique(index[a:b], return_counts=True)
        rows.append((np.append(own, 1 << BITS), np.append(count * (SCALE / max(b - a, 1)), 1.0)))
    model = Ftrl()
    for _ in range(epochs):
        for (own, value), label in zip(rows, labels.tolist(), strict=True):
            model.learn(own, value, label)
    return model.weights(slice(None))


def held_out(key: str):
    """Whether a row belongs to the fold that is never learned from; a null key does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights from at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("key is not null and label in (0, 1)")
    known = known.filter(~held_out("key"))
    rank = F.xxhash64(F.lit(SEED), F.col("key"))
    chosen = known.select("key", "label", rank.alias("rank")).orderBy("rank", "key", "label").limit(sample)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")  # at most ``sample`` rows
    rows = rows.select(F.pmod(F.col("rank"), F.lit(SHARDS)).alias("shard"), "rank", "label", "text")
    rows = rows.dropDuplicates(["shard", "rank", "label"])  # a key's repeated rows count once

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rank", "ascending"), ("label", "ascending")])
        learned = fit_rows(pa.concat_arrays(table["text"].fill_null("").chunks), table["label"].to_numpy())
        used = np.flatnonzero(learned)
        return pa.table({"index": pa.array(used), "weight": learned[used], "rows": pa.array(np.full(len(used), table.num_rows))})

    learned = rows.groupBy("shard").applyInArrow(learn, "index long, weight double, rows long")
    mean = learned.groupBy("index").agg((F.sum("weight") / SHARDS).alias("weight")).collect()  # at most 2 ** BITS + 1 rows
    weights = np.zeros((1 << BITS) + 1)
    for row in mean:
        weights[row["index"]] = row["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                own = scores(shared.value, text_column(piece, "text"))
                columns = [piece.column("key"), piece.column("held_out"), pa.array(own), pa.array((own >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [key, "held_out", "score", "predicted"])

    rows = docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")
