"""Repair of a conversation's structure at the least cost, by the method of the Four Russians.

A conversation is a string of symbols, one per message. What the rest of it costs from each state of the grammar is a
vector of four numbers, which differ by so little that there are only a few such vectors up to a constant. So the
step over a block of ``BLOCK`` symbols is worked out beforehand for every block and every vector: blocks are looked up, from the
conversation's end to its beginning. To tell the edits, each block is then expanded backward from the vector at its
end, symbol by symbol, and walked forward, where of equally cheap edits the one whose letter comes first is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.text import freed, slices
from tillhouse.session import written

#: Symbols of a block.
BLOCK = 4
#: Costs of the edits, and of a truncated message that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after a system message, after a user's, after an assistant's.
STATES, ENDS = 4, (0, 3)
#: The state after a message of each role, where that is allowed.
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state after a message whose role may be chosen (user or assistant).
CHOSEN = (2, 2, 3, 2)
#: Symbols: one that must go, then each kind of role whole and truncated.
ROLES = "sua?"
SYMBOLS = 1 + 2 * len(ROLES)
FAR = 1 << 20


def symbol(role: str, truncated: bool) -> int:
    return 1 + 2 * (ROLES.find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + truncated


# ---- Tables ----


def before(x: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """What the rest costs from each state, ahead of a symbol, from what it costs behind it."""
    role, extra = (None, 0) if x == 0 else (ROLES[(x - 1) // 2], (x - 1) % 2 * TRUNCATED)
    out = []
    for q in range(STATES):
        cost = DELETE + rest[q]
        if role is not None:
            cost = min(cost, REROLE + extra + rest[CHOSEN[q]])
            if role in AFTER and AFTER[role][q] is not None:
                cost = min(cost, extra + rest[AFTER[role][q]])
        out.append(cost)
    return inserted(out)


def inserted(costs: list[int]) -> tuple[int, ...]:
    """With messages put in ahead where that is cheaper. Two in a row lead from any state to any that they can reach."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[CHOSEN[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    return tuple(c - min(costs) for c in costs), min(costs)


END_COSTS = inserted([0 if q in ENDS else FAR for q in range(STATES)])


class Tables:
    """Transitions of normalised cost vectors, by symbol and by block.

    ``vectors`` are the vectors that can occur, the one at the end first; ``ahead[v, x]`` and ``more[v, x]`` the vector ahead of
    a symbol and what it costs on top; ``block_ahead`` and ``block_more`` the same for a block, whose number is that of its
    symbols in base ``SYMBOLS``. ``moves[v, x, q]`` are the letters of the edits up to this symbol's own from state q, and
    the state behind them, where v is the vector behind it.
    """

    def __init__(self, length: int = BLOCK):
        first, _ = normal(END_COSTS)
        self.length, self.vectors = length, [first]
        number, ahead, more = {first: 0}, [], []
        for v in self.vectors:  # grows on the way
            ahead.append([])
            more.append([])
            for x in range(SYMBOLS):
                found, cost = normal(before(x, v))
                if found not in number:
                    number[found] = len(self.vectors)
                    self.vectors.append(found)
                ahead[-1].append(number[found])
                more[-1].append(cost)
        self.ahead, self.more = np.array(ahead), np.array(more)
        to, cost = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(length):  # one more symbol in front
            cost = (cost[:, None, :] + self.more[to].transpose(0, 2, 1)).reshape(len(self.vectors), -1)
            to = self.ahead[to].transpose(0, 2, 1).reshape(len(self.vectors), -1)
        self.block_ahead, self.block_more = to, cost
        self.moves = [[[self._move(v, x, q) for q in range(STATES)] for x in range(SYMBOLS)] for v in range(len(self.vectors))]

    def _move(self, v: int, x: int, q: int) -> tuple[str, int]:
        """Of the cheapest edits ahead of and on a symbol the letters that come first. Letters: D, I, K, R."""
        rest, here = self.vectors[v], before(x, self.vectors[v])
        role, extra = (None, 0) if x == 0 else (ROLES[(x - 1) // 2], (x - 1) % 2 * TRUNCATED)
        said = ""
        while True:
            if DELETE + rest[q] == here[q]:
                return said + "D", q
            if INSERT + here[CHOSEN[q]] == here[q]:
                said, q = said + "I", CHOSEN[q]
            elif role in AFTER and AFTER[role][q] is not None and extra + rest[AFTER[role][q]] == here[q]:
                return said + "K", AFTER[role][q]
            else:
                return said + "R", CHOSEN[q]


@lru_cache(maxsize=4)
def tables(length: int = BLOCK) -> Tables:
    return Tables(length)


def repair(symbols: bytes, length: int = BLOCK) -> tuple[int, str]:
    """The least cost, and the letters of the edits: of the cheapest those that come first in the order of the alphabet."""
    t = tables(length)
    n, short = len(symbols), len(symbols) % length
    codes = np.zeros((n - short) // length, np.int64)
    for k in range(length):  # the short block is the first one
        codes = codes * SYMBOLS + np.frombuffer(symbols, np.uint8)[short + k :: length][: len(codes)]
    behind, v, cost = [0] * (len(codes) + 1), 0, normal(END_COSTS)[1]
    block_ahead, block_more = t.block_ahead, t.block_more
    for k in range(len(codes) - 1, -1, -1):
        cost += int(block_more[v, codes[k]])
        behind[k + 1], v = v, int(block_ahead[v, codes[k]])
    behind[0] = v
    said, q = [], 0
    for k, v in enumerate(behind):
        begin, end = (0, short) if k == 0 else (short + (k - 1) * length, short + k * length)
        inside = [v]
        for x in reversed(symbols[begin:end]):
            inside.append(int(t.ahead[inside[-1], x]))
            if k == 0:
                cost += int(t.more[inside[-2], x])
        if k == 0:
            cost += t.vectors[inside[-1]][0]
        for x, v in zip(symbols[begin:end], reversed(inside[:-1]), strict=True):
            letters, q = t.moves[v][x][q]
            said.append(letters)
    while q not in ENDS:
        said.append("I")
        q = CHOSEN[q]
    return cost, "".join(said)


# ---- Messages ----

SPACES = " \t\n\x0b\x0c\r"


def damage(turns: DataFrame) -> DataFrame:
    """The rows with the contract's faults in them: ``conv_id``, ``turn``, ``role``, ``text``, ``copies`` (0: dropped)."""
    said = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(said.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _digest(text: Column) -> Column:
    """128 bits that tell texts apart and put them in order."""
    return F.unhex(F.md5(text.cast("binary")))


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = frozenset({"su", "ua", "au"})


def audits(messages: DataFrame, length: int = BLOCK) -> DataFrame:
    """Per conversation what is wrong with it, the least cost of its repair and the edits (``OUT``).

    ``messages`` as ``damage`` gives them. Only what is needed of a text travels: its digest, whether it is blank and how it
    ends. Equal rows are counted before the shuffle. One task reads a conversation in order and holds a byte for
    each message, as the result itself does.
    """
    inner = F.rtrim("text", F.lit(SPACES))
    marks = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", _digest(F.col("text")).alias("digest"), "copies",
        (inner == "").alias("blank"), (~F.substring(inner, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    marks = marks.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies"))
    some = marks.filter("copies > 0")
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn"))
    firsts = some.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first")).withColumnsRenamed({"conv_id": "c", "role": "r", "digest": "d"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    marked = some.join(firsts, same).withColumn("fresh", F.col("first") == place).drop("c", "r", "d", "first")
    gone = marks.filter("copies = 0").withColumn("fresh", F.lit(False))  # so that no conversation is left out
    order = ["conv_id", "turn", "role", "digest"]
    ready = marked.unionByName(gone).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "blank", "cut", "copies", "fresh")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, at = [], None, None
        for batch in slices(batches):
            for conv_id, turn, role, blank, cut, copies, fresh in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None or conv_id != now:
                    if at is not None:
                        rows.append(at.told(now, length))
                    now, at = conv_id, _Reading()
                if copies:
                    at.read(turn, role, blank, cut, copies, fresh)
            if rows:
                yield _batch(rows, OUT)
                rows = []
        if at is not None:
            yield _batch([at.told(now, length)], OUT)

    return ready.mapInArrow(lambda it: freed(each(it)), OUT)


class _Reading:
    """A conversation, read message by message."""

    def __init__(self):
        self.symbols = bytearray()
        self.least = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None

    def read(self, turn: int | None, role: str, blank: bool, cut: bool, copies: int, fresh: bool) -> None:
        if turn is not None and turn != self.last:
            self.least, self.last, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in LEGAL
        self.illegal += (copies - 1) * (initial + initial not in LEGAL)
        self.initial = initial
        if blank:
            self.blank += copies
            self.symbols += bytes(copies)
            return
        if fresh:
            self.truncated += cut
            self.symbols.append(symbol(role, cut))
        self.duplicate += copies - fresh
        self.symbols += bytes(copies - fresh)

    def told(self, conv_id: int | None, length: int) -> tuple:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        cost, audit = repair(bytes(self.symbols), length)
        return conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def apply_edits(messages: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations, message by message: ``conv_id``, ``position``, ``role``, ``text``. ``edits`` has ``conv_id``, ``audit``."""
    schema = "conv_id long, position long, role string, text string"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _edited(batches):
            yield _batch(rows, schema)

    return _in_order(messages, edits).mapInArrow(lambda it: freed(each(it)), schema)


def _in_order(messages: DataFrame, edits: DataFrame) -> DataFrame:
    """Each conversation's edits and then its messages, one after the other in one task."""
    heads = edits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    bodies = messages.filter("copies > 0").groupBy(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies")).withColumn("kind", F.lit(1))
    both = heads.unionByName(bodies).withColumn("digest", _digest(F.col("text")))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").select("conv_id", "kind", "role", "text", "copies")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(conversation, position, role, text) of the messages that are left or put in, not many at a time."""
    now = walk = None
    for batch in slices(batches):
        rows: list[tuple] = []
        for conv_id, kind, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                rows.extend(walk.rest() if walk else ())
                now, walk = conv_id, _Walk(conv_id, text)
            else:
                for _ in range(copies):
                    rows.extend(walk.message(role, text))
        if rows:
            yield rows
    if walk and (rows := list(walk.rest())):
        yield rows


class _Walk:
    """Edits, applied to messages as they come."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.position, self.state = conv_id, audit, 0, 0, 0

    def _out(self, role: str, text: str) -> tuple:
        self.position += 1
        return self.conv_id, self.position - 1, role, text

    def _chosen(self) -> str:
        self.state = CHOSEN[self.state]
        return "user" if self.state == 2 else "assistant"

    def rest(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._out(self._chosen(), "")

    def message(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.rest()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            yield self._out(self._chosen(), text)
        elif letter == "K":
            self.state = AFTER[role[:1]][self.state]
            yield self._out(role, text)


def digests(messages: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv_id`` and the sha256 of the repaired conversation, its ``role:text`` joined by line ends. One of which nothing is left has no row.

    A digest is made of a conversation in order, so one task reads it, message by message, and holds none of it.
    """
    schema = "conv_id long, repaired_sha256 string"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = (), None
        for rows in _edited(batches):
            done = []
            for conv_id, position, role, text in rows:
                if (conv_id,) != now:
                    if sha:
                        done.append((now[0], sha.hexdigest()))
                    now, sha = (conv_id,), hashlib.sha256()
                sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            if done:
                yield _batch(done, schema)
        if sha:
            yield _batch([(now[0], sha.hexdigest())], schema)

    return _in_order(messages, edits).mapInArrow(lambda it: freed(each(it)), schema)


def report(turns: DataFrame, length: int = BLOCK) -> DataFrame:
    """Damage the conversations as the contract says, and repair them: what is wrong with each, the edits and their cost.

    Needs ``conv_id`` (a whole number), ``turn``, ``role`` and ``text``; other columns, whatever their names, are not read. Per
    conversation: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``. A null role or
    text is one space. Messages are in order of turn (null first), then role, then digest of the text; equal ones are
    next to each other. Rows without a conversation are one conversation. Roles are told by their first letter; one that
    is not s, u or a can't stay. A conversation of which no row is left has zeros and an empty audit. An empty table
    gives no rows.

    A conversation's digest takes its messages in order, so one task reads it, and the audit is one value as long as the
    conversation; so the task holds a byte for each message, and no texts.
    """
    messages = damage(turns)
    edits = written(audits(messages, length))
    shas = digests(messages, edits.select("conv_id", "audit")).withColumnRenamed("conv_id", "of")
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return edits.join(shas, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(*edits.columns, sha)
