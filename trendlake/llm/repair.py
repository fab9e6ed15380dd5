"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

A repaired conversation is empty, or an optional system turn and then pairs of a user and
an assistant turn. Edits are Keep (0), Rerole to user or assistant (2), Delete (3; the only
one for blank and repeated turns) and Insert an empty user or assistant turn (2); a
truncated turn that is not deleted costs 1 more.

The edits form a lattice with a node for each place between turns and each state of the
pattern. Shortest paths through it are found by the auction algorithm: a path grows from an
origin along the arc of the least cost plus price; where no arc is tight, its last node
bids its price up and the path contracts. Prices never exceed distances, so they are the
distances of all nodes on a path that reaches the end. Origins are taken every ``STRIDE``
turns from the end on, a path stops at a node whose price has converged, and the prices
before it start at the least of those there; so a long conversation costs as much a turn as
a short one. Converged prices show the tight arcs,
and the walk along the first of them by letter is the least audit string.

All turns' faults are found in parallel: repeated turns are counted once for each turn
number before anything is shuffled, and joined to the first place of their role and text.
The solver gets one byte for each turn; only then do the texts of that conversation pass,
from the same sorted partition, so a task holds bytes and prices of one conversation and one
batch of texts. The order of a conversation's turns is that of one task, as its audit and
its digest are one string.

Defined results: null roles and texts are one space; null turn numbers come first; turns of
one number are in the order of a digest of role and text; null conversation keys are one
conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from trendlake.llm.tables import Scratch

SPACE = " \t\n\x0b\f\r"
STRIDE = 32
SHORT = 48  # conversations up to this length share solutions of equal patterns
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
GONE = 8  # a turn that must be deleted; others: 2 * (place of the initial, 3: any other) + truncated
RULES = {"D": 3, "I": 2, "K": 0, "R": 2}


def _arcs(symbol: int | None, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, step to the next node) in the order of letters. ``None``: no turn is left."""
    arcs, on = [], FOLLOWS[state]
    if symbol is not None:
        arcs.append(("D", RULES["D"], 4))
    arcs.append(("I", RULES["I"], on - state))
    if symbol is not None and symbol != GONE:
        role, late = divmod(symbol, 2)
        kept = {"s": SYSTEM if state == START else None, "u": USER if on == USER else None, "a": ASSISTANT if on == ASSISTANT else None}
        to = kept[INITIALS[role]] if role < 3 else None
        if to is not None:
            arcs.append(("K", RULES["K"] + late, 4 + to - state))
        arcs.append(("R", RULES["R"] + late, 4 + on - state))
    return arcs


ARCS = {symbol: [_arcs(symbol, state) for state in range(4)] for symbol in (None, *range(GONE + 1))}


class Auction:
    """Distances to the end of the lattice of one conversation's symbols."""

    def __init__(self, symbols: bytes):
        self.symbols, self.n = symbols, len(symbols)
        self.price = [0] * (4 * self.n + 4)
        self.exact = bytearray(4 * self.n + 4)
        self.exact[4 * self.n + START] = self.exact[4 * self.n + ASSISTANT] = 1
        for place in range((self.n - 1) // STRIDE * STRIDE, -1, -STRIDE):
            after = min(place + STRIDE, self.n)
            self.settle_all(after)
            # No node before a place is nearer to the end than the nearest one of that place.
            floor = min(self.price[4 * after : 4 * after + 4])
            self.price[4 * place : 4 * after] = [floor] * (4 * (after - place))
        self.settle_all(0)

    def settle_all(self, place: int) -> None:
        for state in range(4):
            self.settle(4 * place + state)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        place = node >> 2
        return ARCS[self.symbols[place] if place < self.n else None][node & 3]

    def settle(self, origin: int) -> None:
        """Extend and contract a path from ``origin`` until it reaches a node whose price is its distance."""
        price, path = self.price, [origin]
        while not self.exact[path[-1]]:
            node = path[-1]
            least, step = min([(cost + price[node + step], step) for _, cost, step in self.arcs(node)])
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(node + step)
        for node in path:
            self.exact[node] = 1

    def trace(self) -> tuple[int, str]:
        """The least cost, and the first by letters of all cheapest edits."""
        node, letters, last = START, [], 4 * self.n
        while node not in (last + START, last + ASSISTANT):
            for letter, cost, step in self.arcs(node):
                if self.price[node] == cost + self.price[node + step]:
                    self.settle(node + step)
                    if self.price[node] == cost + self.price[node + step]:  # still tight at the distance
                        letters.append(letter)
                        node += step
                        break
        return self.price[START], "".join(letters)


@lru_cache(maxsize=50_000)
def _short(symbols: bytes) -> tuple[int, str]:
    return Auction(symbols).trace()


def cheapest(symbols: bytes) -> tuple[int, str]:
    """Cost and letters of the edits of a conversation given by its symbols."""
    return _short(symbols) if len(symbols) <= SHORT else Auction(symbols).trace()


def turns(rows: DataFrame, conv: str, turn: str, role: str, text: str, damage: bool) -> DataFrame:
    """(conv, turn, role, text, copies, last): the turns to repair; ``last``: the last visible character."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), F.lit(1).alias("copies"),
                      F.pmod(F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn))), F.lit(20)).alias("code"))
    if damage:
        code = F.col("code")
        out = out.withColumns({
            "text": F.when(code == 1, "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(code == 4, "user").otherwise(F.col("role")),
            "copies": F.when(code == 0, 0).when(code == 3, 2).otherwise(1),
        })
    return out.drop("code").withColumn("last", F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1)))


def _faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, d, n, initial, last, first): each different turn once, with its number of copies."""
    own = rows.groupBy("conv", "turn", "d").agg(
        F.sum("copies").alias("n"), F.first("last").alias("last"), F.first(F.left("role", F.lit(1))).alias("initial")
    )
    own = scratch.write(own, "turns")
    # Null numbers are first: their flag is false, and false sorts before true.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = own.filter("n > 0").groupBy(F.col("conv").alias("c"), F.col("d").alias("e")).agg(F.min(place).alias("least"))
    joined = own.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("d") == F.col("e")), "left")
    return joined.select("conv", "turn", "d", "n", "last", "initial", F.col("least.turn").eqNullSafe(F.col("turn")).alias("first"))


class Conversation:
    """What is known of one conversation while its rows pass: turns first, then texts."""

    def __init__(self, key):
        self.key = key
        self.symbols = bytearray()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns = self.least = self.most = self.before = None
        self.place = 0
        self.audit: str | None = None
        self.cost = 0
        self.state = START

    def add_turn(self, turn, n: int, last: str, initial: str, first: bool) -> None:
        if not n:
            return
        pair = (self.before or "") + initial
        self.counts["illegal"] += (self.before is not None and pair not in ("su", "ua", "au")) + n - 1
        self.before = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, (self.turns or 0) + 1
        if not last:
            self.counts["blank"] += n
            self.symbols += bytes([GONE]) * n
            return
        self.counts["duplicate"] += n - first
        if first:
            late = last not in ".!?"
            self.counts["truncated"] += late
            self.symbols.append(2 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + late)
        self.symbols += bytes([GONE]) * (n - first)

    def solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest(bytes(self.symbols))
            self.symbols = bytearray()

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns that are put in before the next one."""
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.place += 1
            self.state = FOLLOWS[self.state]
            yield "I", NAMES[self.state], ""

    def add_text(self, copies: int, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired turns up to this one."""
        self.solve()
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.place]
            self.place += 1
            if edit == "K":
                self.state = SYSTEM + INITIALS.index(role[0])
                yield edit, role, text
            elif edit == "R":
                self.state = FOLLOWS[self.state]
                yield edit, NAMES[self.state], text

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.solve()
        yield from self.inserted()

    def gaps(self) -> int:
        return self.most - self.least + 1 - self.turns if self.turns else 0


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, tuple[str, str, str] | None]]:
    """(conversation, repaired turn) of sorted rows in order; a turn of None ends the conversation."""
    own = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "phase", "turn", "n", "last", "initial", "first", "role", "text")), strict=True):
            key, phase, turn, n, last, initial, first, role, text = row
            if own is None or key != own.key:
                if own is not None:
                    yield from ((own, t) for t in own.end())
                    yield own, None
                own = Conversation(key)
            if phase:
                yield from ((own, t) for t in own.add_text(n, role, text))
            else:
                own.add_turn(turn, n, last, initial, first)
    if own is not None:
        yield from ((own, t) for t in own.end())
        yield own, None


def _sorted(rows: DataFrame, conv: str, turn: str, role: str, text: str, damage: bool) -> DataFrame:
    """Each conversation's different turns, then its texts, in order and in one partition."""
    given = turns(rows, conv, turn, role, text, damage).withColumn("d", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    light = _faults(given, Scratch(rows.sparkSession, "repair")).withColumn("phase", F.lit(0))
    heavy = given.filter("copies > 0").select("conv", "turn", "d", F.col("copies").cast("long").alias("n"), "role", "text", F.lit(1).alias("phase"))
    both = light.unionByName(heavy, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", "phase", "turn", "d")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FLUSH = 4_096
FLUSH_BYTES = 4 << 20


class Rows:
    """Collected output rows, given out as batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.columns, self.size = schema, [[] for _ in schema], 0

    def add(self, values: tuple, size: int) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.size += size

    def batches(self, least: int = FLUSH, most_bytes: int = FLUSH_BYTES) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= least or self.size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
            self.columns, self.size = [[] for _ in self.schema], 0


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False) -> DataFrame:
    """(conv, place, edit, role, text): the turns of every repaired conversation, in places from 0 on."""
    schema = pa.schema([(conv, to_arrow_type(rows.schema[conv].dataType)), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = Rows(schema), 0
        for own, made in _walk(batches):
            if made is None:
                place = 0
                continue
            out.add((own.key, place, *made), len(made[2]))
            place += 1
            yield from out.batches()
        yield from out.batches(1)

    return _sorted(rows, conv, turn, role, text, damage).mapInArrow(run, from_arrow_schema(schema))


def digests(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True) -> DataFrame:
    """One row for each conversation key of ``rows``: its faults, cheapest edits, and the SHA-256 of the repaired turns."""
    key = pa.field(conv, to_arrow_type(rows.schema[conv].dataType))
    schema = pa.schema([key, *(pa.field(c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = Rows(schema), None
        for own, made in _walk(batches):
            if made is not None:
                line = f"{made[1]}:{made[2]}".encode()
                if digest is None:
                    digest = hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
                continue
            counts = own.counts | {"gaps": own.gaps(), "cost": own.cost}
            out.add((own.key, *(counts[c] for c in COUNTS), own.audit, (digest or hashlib.sha256()).hexdigest()), len(own.audit))
            digest = None
            yield from out.batches()
        yield from out.batches(1)

    return _sorted(rows, conv, turn, role, text, damage).mapInArrow(run, from_arrow_schema(schema))
