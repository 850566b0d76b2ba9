from __future__ import annotations

import random

import numpy as np
import xxhash

from material import ODD, documents
from tillhouse.llm import golay
from tillhouse.llm.components import smallest_reachable
from tillhouse.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """(id, fingerprint) pairs: every row's smallest reachable id."""
    parent = {f: f for _, f in items}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for d, f in items:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in items), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_word_is_near_one_codeword():
    words = np.arange(1 << 23, dtype=np.int64)[:: 1 << 5]
    errors = golay.error_patterns()[golay.remainders(words)][:, 0]
    assert max(int(e).bit_count() for e in errors.tolist()) == 3
    assert not golay.remainders(words ^ errors).any()


def test_keys_meet_at_any_three_bits():
    rng = random.Random(5)
    for n in (0, 1, 2, 3) * 60:
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), n):
            b ^= 1 << bit
        x, y = (np.array([v], np.uint64).view(np.int64) for v in (a, b))
        assert set(golay.keys(x, True)[1].tolist()) & set(golay.keys(y, False)[1].tolist())


def test_query_equals_brute_force(spark, sf):
    items = [(d, plain_fingerprint(t)) for d, t in documents(sf)]
    assert rows(QUERIES["op4_golay_simhash"](spark, sf)) == plain_components(items)


def test_odd_texts_null_ids_and_repeats(docs_of):
    texts = ODD + ["one", None, "solo text here now"]
    ids = [*range(len(ODD)), 3, None, None]
    docs = docs_of(texts, ids, fp=["x"] * len(texts), root=["y"] * len(texts))
    assert rows(golay.components(docs)) == plain_components([(i, plain_fingerprint(t)) for i, t in zip(ids, texts, strict=True)])


def test_crowds_reach_what_pairs_reach(spark):
    rng = random.Random(9)
    centre, fps = rng.getrandbits(64), set()
    while len(fps) < 40:  # a crowd within a few bits, some strangers, some at a distance of exactly three from one another
        f = centre
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            f ^= 1 << bit
        fps |= {f, rng.getrandbits(64)}
    signed = [int(np.array([f], np.uint64).view(np.int64)[0]) for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")

    def groups(crowd):
        return sorted((r.node, r.root) for r in smallest_reachable(golay.links(frame, crowd)).collect())

    assert groups(1) == groups(10**6) != []


def test_one_stays_of_each_group(docs_of):
    long = " ".join(f"w{i}" for i in range(400))
    texts = [long, long, long + " end", "something else entirely here", None, "", long]
    docs = docs_of(texts, [5, 2, 9, 7, 8, 4, 2], __x=list("abcdefg"))
    got = golay.keep_one(docs)
    assert got.schema == docs.schema
    assert sorted(r.doc_id for r in got.collect()) == [2, 4, 7]
    assert golay.keep_one(docs_of([None, "a b", None], [None, None, None])).count() == 2


def test_empty_table(docs_of):
    assert golay.components(docs_of([])).collect() == []
    assert golay.keep_one(docs_of([])).collect() == []


def test_chains_settle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in smallest_reachable(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_nothing_that_grows_with_the_fingerprints_is_broadcast(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i // 2} and {i % 3} more") for i in range(60)], "doc_id long, text string")
    for found in (golay.components(docs), golay.keep_one(docs)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
