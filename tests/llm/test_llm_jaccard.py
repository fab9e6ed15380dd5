import random
import re

import numpy as np
import pytest

from trendlake.llm import jaccard
from trendlake.llm.setjoin import Group

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_sets(texts, width):
    out = []
    for text in texts:
        words = WORD.findall((text or "").translate(UPPER))
        out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set())
    return out


def brute(rows, width, percent):
    """id -> (set size, least id of its group, number of links), every pair compared."""
    sets = brute_sets([t for _, t in rows], width)
    linked = [
        [j for j in range(len(rows)) if j != i and a and 100 * len(a & sets[j]) >= percent * len(a | sets[j])] for i, a in enumerate(sets)
    ]
    out = {}
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[key] = (len(sets[i]), min(rows[j][0] for j in seen), len(linked[i]))
    return out


def near_copies(seed, groups=12, size=9, length=70, edits=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    boilerplate = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, length))]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own + (boilerplate if rng.random() < 0.5 else [])))
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("width", "percent", "sparse"), [(3, 90, 4), (5, 80, 4), (2, 60, 2)])
def test_groups_equal_brute_force(spark, width, percent, sparse, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 6)  # candidate groups are cut into parts
    rows = near_copies(width) + [(1, None), (2, ""), (4, "One"), (5, "one"), (7, "a b"), (8, " A\tB "), (10, " "), (11, "x " * 500)]
    rows += [(13, rows[0][1]), (14, rows[0][1].upper())]
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent, sparse=sparse)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got.collect()} == brute(rows, width, percent)


def test_repeated_rows_null_keys_clashing_columns_and_no_rows(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 1), (None, "a b c d e f", 2), (None, "only here with no key", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = sorted((tuple(r) for r in jaccard.similar_groups(docs).collect()), key=repr)
    assert got == sorted([(1, 2, 1, 2), (1, 2, 1, 2), (None, 2, 1, 2), (None, 1, None, 0)], key=repr)
    assert jaccard.similar_groups(docs.limit(0)).collect() == []


def test_group_join_counts_links_between_sides_only():
    sets = [np.arange(k, k + 20).astype(np.int64) for k in (0, 0, 1, 40)]
    root, links = Group(sets, np.array([0, 0, 1, 1]), 80).join(np.array([1, 5, 1, 1]))
    assert root.tolist() == [0, 0, 0, 3]
    assert links.tolist() == [1, 1, 6, 0]


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_group_join_equals_all_pairs(percent):
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 5000, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) > 0.06], rng.integers(0, 5000, rng.integers(0, 9))])) for _ in range(120)]
    sets += [np.unique(rng.integers(0, 300, rng.integers(1, 40))) for _ in range(80)]
    root, links = Group(sets, np.zeros(len(sets), int), percent).join(np.ones(len(sets), int))
    plain = [{*s.tolist()} for s in sets]
    near = [[j for j, b in enumerate(plain) if j != i and 100 * len(a & b) >= percent * len(a | b)] for i, a in enumerate(plain)]
    assert links.tolist() == [len(x) for x in near]
    assert all(root[i] == root[j] for i, x in enumerate(near) for j in x)
    assert len(set(root)) == len({min(_reach(i, near)) for i in range(len(sets))})


def _reach(i, near):
    seen, todo = {i}, [i]
    while todo:
        for j in near[todo.pop()]:
            if j not in seen:
                seen.add(j)
                todo.append(j)
    return seen
