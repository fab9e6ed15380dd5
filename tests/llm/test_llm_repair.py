import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from trendlake.llm import repair

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
SHAPE = re.compile(r"(s?(ua)+)?")


def brute_edits(turns):
    """All cheapest edit strings by search over every place and every result so far; turns: (initial, must go, truncated)."""
    front = {("", ""): 0}  # (edits, roles) -> cost
    names = "ua"

    def with_inserts(states):
        out = dict(states)
        for _ in range(2):
            for (edits, roles), cost in list(out.items()):
                for c in names:
                    if re.fullmatch(r"s?(ua)*u?", roles + c):
                        out[edits + "I", roles + c] = cost + 2
        return out

    for initial, gone, late in turns:
        after = {}
        for (edits, roles), cost in with_inserts(front).items():
            options = [("D", roles, 3)]
            if not gone:
                options += [("K", roles + initial, late)] + [("R", roles + c, 2 + late) for c in names]
            for letter, made, price in options:
                if re.fullmatch(r"s?(ua)*u?", made):
                    after[edits + letter, made] = cost + price
        front = after
    done = {k: v for k, v in with_inserts(front).items() if SHAPE.fullmatch(k[1])}
    least = min(done.values())
    return least, min(e for (e, _), c in done.items() if c == least)


def backward_edits(turns):
    """The same by suffixes, for long conversations: least (cost, edits) from each state."""
    inf = (10**9, "")
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best):
        for _ in range(3):
            for state in range(4):
                on = next(step[state][c] for c in "ua" if c in step[state])
                best[state] = min(best[state], (best[on][0] + 2, "I" + best[on][1]))
        return best

    best = inserted([(0, ""), inf, inf, (0, "")])
    for initial, gone, late in reversed(turns):
        new = []
        for state in range(4):
            options = [(best[state][0] + 3, "D" + best[state][1])]
            if not gone:
                if initial in step[state]:
                    to = best[step[state][initial]]
                    options.append((to[0] + late, "K" + to[1]))
                for c in "ua":
                    if c in step[state]:
                        to = best[step[state][c]]
                        options.append((to[0] + 2 + late, "R" + to[1]))
            new.append(min(options))
        best = inserted(new)
    return best[0]


def symbols(turns):
    return bytes(repair.GONE if gone else 2 * ("sua".index(i) if i in "sua" else 3) + late for i, gone, late in turns)


def test_edits_equal_search_over_all_results():
    kinds = [("s", 0, 0), ("u", 0, 0), ("a", 0, 1), ("x", 0, 0), ("u", 1, 0)]
    for n in range(4):
        for turns in itertools.product(kinds, repeat=n):
            assert repair.cheapest(symbols(turns)) == brute_edits(turns), turns


@pytest.mark.parametrize("n", [7, 31, 32, 33, 64, 400])
def test_edits_of_longer_conversations_equal_distances_by_suffix(n):
    rng = random.Random(n)
    for _ in range(30):
        turns = [(rng.choice("suuaax"), int(rng.random() < 0.15), int(rng.random() < 0.2)) for _ in range(n)]
        assert repair.cheapest(symbols(turns)) == backward_edits(turns)


def test_cost_a_turn_does_not_grow():
    """Bids and extensions of a conversation ten times as long are about ten times as many."""
    rng = random.Random(3)
    steps = []

    class Counted(repair.Auction):
        def arcs(self, node):
            steps[-1] += 1
            return super().arcs(node)

    for n in (2_000, 20_000):
        turns = [(rng.choice("uuax"), int(rng.random() < 0.2), int(rng.random() < 0.2)) for _ in range(n)]
        steps.append(0)
        assert Counted(symbols(turns)).trace() == backward_edits(turns) if n < 5_000 else Counted(symbols(turns)).trace()[0] > 0
    assert steps[1] < 13 * steps[0]


def brute(rows):
    """The contract's row of every conversation, from (conv, turn, role, text) rows."""
    made = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_text, turn_text, role, text = (" " if v is None else str(v) for v in (conv, turn, role, text))
        code = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        made[conv] += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = {}
    for conv, turns in made.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        counts, seen, states = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in turns:
            visible = VISIBLE.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            states.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum((a[0] + b[0]) not in ("su", "ua", "au") for a, b in zip(states, states[1:]))
        cost, audit = backward_edits(states)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        lines, left, roles = [], list(turns), ""
        for edit in audit:
            row = left.pop(0) if edit != "I" else None
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if roles.endswith("u") else "user"
            lines.append(f"{role}:{row[2] if row else ''}")
            roles += role[:1]
        assert SHAPE.fullmatch(roles)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


ROWS = [
    (1, None, "user", "no number."), (1, 3, None, None), (1, 9, "user", "Again?"), (1, 10, "user", "Again?"), (1, 10, "admin", "x."),
    (2, 1, "", "y."), (2, 2, "tool", "z"), (None, 1, "user", "nobody's."), (None, 2, "assistant", "ok \t\n"), (3, 5, "system", ""), (3, 5, "system", ""),
    *[(4, t, ("user", "assistant")[t % 2], f"turn {t}." if t % 7 else "same.") for t in range(400)], *[(5, 1, "user", "hot.")] * 300,
    *[(i, t, ("system", "user", "assistant")[min(t, 2 - t % 2)], f"said {t}" + "." * (t % 3)) for i in range(100, 260) for t in range(i % 7)],
    *[(1000 + i, 0, "user", "alone") for i in range(60)],
]


def got_rows(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_digests_equal_brute_force(spark):
    rows = spark.createDataFrame([(*r, "clash", 7) for r in ROWS], "conv_id long, turn long, role string, text string, audit string, n int").repartition(5)
    want = brute(ROWS)
    got = got_rows(repair.digests(rows))
    assert got == {k: v[:-1] for k, v in want.items()}
    assert any(v[6] == "" and v[0] == 0 for v in got.values())
    lines = defaultdict(list)
    for r in sorted(repair.repaired(rows, damage=True).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {k: v[-1] for k, v in want.items() if v[-1]}


def test_whole_table_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])
    assert got_rows(repair.digests(rows)) == {k: v[:-1] for k, v in want.items()}


def test_text_keys_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes.")], "conv_id string, turn int, role string, text string")
    assert [tuple(r) for r in repair.repaired(rows).orderBy("place").collect()] == [("a", 0, "K", "user", "Hi."), ("a", 1, "K", "assistant", "Yes.")]
    assert repair.digests(rows.limit(0)).collect() == []
