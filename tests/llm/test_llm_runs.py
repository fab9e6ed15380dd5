import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from trendlake.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:])))


def brute_runs(words):
    """Every maximal stretch of matches on every diagonal, if its lag is its smallest period."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(key, text, damage=True):
    words = WORD.findall(text or "")
    n = len(words)
    if damage and key is not None and n:
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    shown = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (key, len(found), *shown, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def planted(rng):
    """Words over few letters with repetitions of random periods, some of them nested or side by side."""
    words = []
    while len(words) < rng.randint(0, 400):
        root = [rng.choice("abcde") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 40]))]
        if rng.random() < 0.3:
            root = root * 2 + ["z"]
        words += (root * rng.randint(1, 6))[: rng.randint(1, 150)] if rng.random() < 0.7 else [str(rng.random())]
    return words


def test_runs_of_a_batch_equal_brute_force():
    rng = random.Random(5)
    texts = [planted(rng) for _ in range(150)] + [[], ["a"] * 500, ["a"] * 24, ["a"] * 23, list("ab") * 12, list("abcdefgh") * 3, list("abcdefghi") * 3, list("abcdefghi") * 2]
    number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    codes = np.array([number[w] for t in texts for w in t], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = [tuple(r) for r in runs.Diagonals(codes, offsets).runs().tolist()]
    assert got == [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t)]
    assert len(got) > 100


def test_seeds_are_few_where_grams_are_frequent():
    """A text of one word and one of a long period read each diagonal once."""
    n, seen = 200_000, []

    class Counted(runs.Diagonals):
        def _matches(self, at, lag, step):
            seen.append(super()._matches(at, lag, step))
            return seen[-1]

    codes = np.concatenate([np.zeros(n, np.int64), np.arange(n) % 60_000])
    got = Counted(codes, np.array([0, n, 2 * n])).runs().tolist()
    assert got == [[0, 0, n, 1], [1, 0, n, 60_000]]
    assert len(seen) <= 4 and sum(seen) < 2 * n


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    texts = [None, "", " \t\n", "one", " ".join(["x"] * 30), "a b c " * 40, "é\n" * 50] + [" ".join(planted(rng)) for _ in range(120)]
    rows = [(i, t, "clash", 0) for i, t in enumerate(texts)] + [(7, "again " * 26, "r", 1)] * 2 + [(None, "no key " * 20, "n", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, key int").repartition(3)


def test_digests_equal_brute_force(docs):
    got = sorted(map(tuple, runs.digests(docs).collect()), key=str)
    assert got == sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=str)
    plain = sorted(map(tuple, runs.digests(docs, damage=False).collect()), key=str)
    assert plain == sorted((brute_row(r.doc_id, r.text, False) for r in docs.collect()), key=str)


def test_damaged_documents_of_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = [r for r in docs.select("doc_id", "text").collect() if len((r.text or "").split()) < 1_500]
    got = {r.doc_id: tuple(r) for r in runs.digests(docs).collect()}
    assert len(got) == docs.count()
    assert all(got[r.doc_id] == brute_row(r.doc_id, r.text) for r in short[:120])
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_runs_and_collapsed_text(spark):
    rows = [(1, "see " + "go on " * 20 + "end"), (2, "plain  text")]
    got = {r.doc_id: r for r in runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 40, 2)] and got[1].collapsed == "see go on end"
    assert got[2].runs == [] and got[2].collapsed == "plain text"


def test_no_rows(docs):
    assert runs.digests(docs.limit(0)).collect() == []
