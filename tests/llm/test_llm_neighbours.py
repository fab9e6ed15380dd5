import math
from collections import Counter

import numpy as np
import pytest

from trendlake.llm import neighbours


def brute(rows, cosine=0.9):
    """n_links and component of every row by all pairs; rows: (id, vector or None)."""
    known = [(i, np.array([math.nan if x is None else x for x in v], float)) for i, (_, v) in enumerate(rows) if v]
    known = [(i, v) for i, v in known if np.isfinite(v).all() and v.any()]
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for width in {len(v) for _, v in known}:
        own = [(i, v / np.linalg.norm(v)) for i, v in known if len(v) == width]
        sims = np.array([v for _, v in own]) @ np.array([v for _, v in own]).T
        for a, b in zip(*np.nonzero(np.triu(sims >= cosine, 1)), strict=True):
            i, j = own[a][0], own[b][0]
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, links[i], c := least.get(find(i)), k is not None and k == c) for i, (k, _) in enumerate(rows)), key=str)


def noisy(rng, centre, n, noise):
    return centre + rng.normal(size=(n, len(centre))) * noise / math.sqrt(len(centre))


@pytest.fixture
def small(monkeypatch):
    """Small leaves, blocks and parts, so that a few thousand vectors meet every path."""
    for name, value in {"LEAF": 64, "BLOCK": 96, "PART": 50, "ROWS": 32}.items():
        monkeypatch.setattr(neighbours, name, value)


def clusters(rng):
    lone = rng.normal(size=(700, 32))
    one, two, far = (v / np.linalg.norm(v) for v in rng.normal(size=(3, 32)))
    near = one * math.cos(0.42) + (two - one * (one @ two)) / np.linalg.norm(two - one * (one @ two)) * math.sin(0.42)
    clumps = [noisy(rng, one, 200, 0.02), noisy(rng, near, 150, 0.02)]  # two clumps whose pairs lie about the threshold
    wide = noisy(rng, far, 120, 0.5)  # a component that is no clique
    pairs = lone[:80] + rng.normal(size=(80, 32)) * 0.05
    return np.concatenate([lone, *clumps, wide, pairs])


def test_links_and_components_equal_all_pairs(spark, small):
    rng = np.random.default_rng(1)
    vectors = clusters(rng).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(9_000 + i, vectors[3].tolist()) for i in range(40)]
    rows += [(9_100, None), (9_101, [0.0] * 32), (9_102, [1.0, None]), (9_103, [math.inf] * 32), (9_104, []), (9_105, [1.0, 1.0]), (9_106, [2.0, 2.0]), (9_106, [2.0, 2.0])]
    rows += [(9_107, [math.nan] + [1.0] * 31), (None, vectors[5].tolist()), (None, [3.0, -4.0, 1.0])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, n_links string").repartition(4)
    got = sorted((tuple(r) for r in neighbours.similar_vectors(df, recall=1.0).collect()), key=str)
    assert got == brute(rows)
    assert max(r[1] for r in got) > 150


def test_doubles_and_text_keys(spark, small):
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(size=(150, 8)) * 1e200, rng.normal(size=(150, 8)) * 1e-200])
    rows = [(f"v{i:03}", v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    want = brute([(k, (np.array(v) / np.abs(v).max()).tolist()) for k, v in rows])
    assert sorted((tuple(r) for r in neighbours.similar_vectors(df, recall=1.0).collect()), key=str) == want


def test_no_rows_and_one_row(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.similar_vectors(df).collect()] == [(5, 0, 5, True)]
    assert neighbours.similar_vectors(df.limit(0)).collect() == []


def test_large_clique_is_counted_by_its_centre(spark, small, monkeypatch):
    """All members within half the angle: no block is compared."""
    rng = np.random.default_rng(3)
    vectors = noisy(rng, np.eye(16)[0], 300, 0.1).astype(np.float32)
    asked = []
    real = neighbours._block_links
    monkeypatch.setattr(neighbours, "_block_links", lambda blocks, *a: (asked.append(blocks.count()), real(blocks, *a))[1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = neighbours.similar_vectors(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)} and asked == [0]


def test_sets_of_edges():
    a, b = np.array([0, 2, 5, 7, 8]), np.array([1, 5, 9, 8, 9])
    assert neighbours._least_of_sets(10, a, b).tolist() == [0, 0, 2, 3, 4, 2, 6, 2, 2, 2]
    assert neighbours._least_of_sets(3, a[:0], b[:0]).tolist() == [0, 1, 2]


def test_rows_are_thinned_out_before_they_leave_a_task():
    kind, a, b = [0, 0, 0, 0, 0, 1, 1, 2], [7, 7, 7, 7, 8, 7, 7, 7], [1, 2, 1, 3, 1, 2, 2, 2]
    rows = np.rec.fromarrays([np.array(kind, np.int32), np.array(a), np.array(b), np.array([0.8, 0.9, 0.8, 0.7, 0.95, 1, 1, 0.9], np.float32)], names=["kind", "a", "b", "sim"])
    got = neighbours.nearest_rows(rows, 2)
    assert sorted(tuple(r)[:3] for r in got.tolist()) == [(0, 7, 1), (0, 7, 2), (0, 8, 1), (1, 7, 2), (2, 7, 2)]
    assert len(neighbours.nearest_rows(rows[:0], 2)) == 0
