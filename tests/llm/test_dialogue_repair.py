from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm import dialogue
from tillhouse.llm.queries import QUERIES

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(marks):
    """(initial, must go, truncated) per message: the least (cost, audit, roles) over all edits, the cheapest first, by a queue.

    Roles are None for a message that is deleted, True for one that keeps its own.
    """
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, roles = heapq.heappop(queue)
        if at == len(marks) and last in ("", "a"):
            return cost, audit, roles
        if (at, last) in seen:
            continue
        seen.add((at, last))
        steps = [(2, "I", at, r) for r in "ua"]
        if at < len(marks):
            initial, go, cut = marks[at]
            steps.append((3, "D", at + 1, None))
            if not go:
                steps.append((cut, "K", at + 1, initial))
                steps += [(2 + cut, "R", at + 1, r) for r in "ua"]
        for extra, letter, to, r in steps:
            if r is None or r and last + r in ("s", "u", "su", "ua", "au"):
                heapq.heappush(queue, (cost + extra, audit + letter, to, last if r is None else r, (*roles, (letter, r))))
    raise AssertionError


def plain(rows):
    """The contract, one conversation after the other."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        said = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20
        r, x = "user" if k == 4 else said(r), said(x)
        x = "" if k == 1 else re.sub(r"[.!?]", "", x) if k == 2 else x
        convs[c] += [(t, r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = []
    for c, found in convs.items():
        found.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), hashlib.md5(m[2].encode()).digest()))
        turns = {t for t, _, _ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, r, x in found:
            body = x.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (r, x) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((r, x))
            if fault is not None:
                counts[fault] += 1
            marks.append((r[:1], fault in (0, 1), int(fault == 2)))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, roles = plain_repair(marks)
        lines, at = [], 0
        for letter, r in roles:
            role = {"u": "user", "a": "assistant"}.get(r)
            if letter == "I":
                lines.append(f"{role}:")
                continue
            if letter == "K":
                lines.append(f"{found[at][1]}:{found[at][2]}")
            if letter == "R":
                lines.append(f"{role}:{found[at][2]}")
            at += 1
        out.append((c, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, folder):
    where = f"/root/testdata/{folder}"
    items = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{where}/conversations.parquet'").fetchall()
    got = rows(QUERIES["op12_four_russians_repair"](spark, where))
    assert got == plain(items)
    assert len({r[-2] for r in got}) > 10


def test_odd_rows(spark):
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "sys", "a"]
    texts = ["Yes.", "No!", "what", "", " \t\r\n", None, "x. \x0b", "é? ", "a\x85", "." * 5, "line\nline.", "z" * 3000, " " * 9]
    items = []
    for c in [*range(60), None]:
        for _ in range(rng.randrange(0, 14)):
            items.append((c, rng.choice([None, 0, 0, 1, 2, 3, 5, 9, -4]), rng.choice(roles), rng.choice(texts)))
    items += items[:40]
    frame = spark.createDataFrame([(*i, "x", 1) for i in items], f"{SCHEMA}, audit string, copies int")
    assert rows(dialogue.report(frame)) == plain(items)


def test_a_long_conversation_and_many_copies(spark):
    rng = random.Random(4)
    items = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["One.", f"{t}!", "open"])) for t in range(500)] + [(8, 2, "user", "same.")] * 700
    frame = spark.createDataFrame(items, SCHEMA)
    assert rows(dialogue.report(frame)) == plain(items)


def test_all_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 1, "user", "Hi.")], SCHEMA)
    assert rows(dialogue.report(frame)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert dialogue.report(frame.limit(0)).collect() == []


def as_marks(symbols):
    return [("sua?"[(x - 1) // 2], False, (x - 1) % 2) if x else ("u", True, 0) for x in symbols]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, dialogue.SYMBOLS - 1), max_size=13), st.integers(1, 5))
def test_any_string_of_symbols_in_blocks_of_any_length(symbols, length):
    assert dialogue.repair(bytes(symbols), length) == plain_repair(as_marks(symbols))[:2]


def test_tables_hold_few_vectors_and_every_block():
    t = dialogue.tables()
    assert len(t.vectors) < 100
    assert t.block_ahead.shape == t.block_more.shape == (len(t.vectors), dialogue.SYMBOLS**dialogue.BLOCK)


def test_repaired_messages_follow_the_grammar(spark):
    messages = dialogue.damage(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    got = dialogue.apply_edits(messages, dialogue.audits(messages).select("conv_id", "audit")).collect()
    roles = defaultdict(str)
    for r in sorted(got, key=lambda r: (r.conv_id, r.position)):
        roles[r.conv_id] += r.role[:1]
    assert roles and all(GRAMMAR.fullmatch(x) for x in roles.values())
