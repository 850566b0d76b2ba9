from __future__ import annotations

import math

import numpy as np

from tillhouse.llm import bitslice
from tillhouse.llm.queries import QUERIES


def plain(vectors, queries, k=5):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {i: v for i, v in reversed([q for q in usable if q[0] in queries])}
    out = []
    for own, q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in usable if i != own)[:k]
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, score string, rank string")


def run(spark, rows, queries, **more):
    df = frame(spark, rows)
    return sorted(tuple(r) for r in bitslice.top_k(df, df.filter(df.vec_id.isin(list(queries))), **more).collect())


def test_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain(rows, {i for i, _ in rows if i % 50 == 0})
    assert sorted(tuple(r) for r in QUERIES["op5_bit_sliced_top_k"](spark, sf).collect()) == want


def test_ties_copies_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(400)] + [(1000 + i, [1.0] * 6) for i in range(200)]
    queries = {0, 7, 399, 1000, 1100}
    for block in (64, 10_000):
        assert run(spark, rows, queries, block=block) == plain(rows, queries)


def test_unusable_vectors_and_few_rows(spark):
    rows = [(0, [0.5, -0.25]), (50, [float("nan"), 1.0]), (100, None), (3, [1.0, None]), (4, [float("inf"), 0.0]), (5, [2.0, 100.0]), (None, [9.0, 9.0]), (6, [])]
    assert run(spark, rows, {0, 50, 100}) == plain(rows, {0, 50, 100}) != []


def test_wide_range_and_negative_weights():
    rng = np.random.default_rng(4)
    values = (rng.normal(0, 1, (3000, 9)) * 10.0 ** rng.integers(0, 5, 9)).astype(np.int64)
    ids = rng.permutation(3000)
    block = bitslice.Block(ids, values)
    for q in (values[0], -values[5], np.zeros(9, np.int64), np.eye(9, dtype=np.int64)[2] * -7):
        want = sorted((-int(s), int(i)) for s, i in zip(values @ q, ids, strict=True) if i != 17)[:5]
        assert block.top(q, 17, 5) == [(i, -s) for s, i in want]


def test_repeated_queries_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, rows, {0}) == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)]
    assert run(spark, [], {0}) == []


def test_a_query_id_with_a_usable_and_an_unusable_row(spark):
    rows = [(50, [None, 5.0]), (50, [0.5, 1.0]), (50, [float("nan"), 0.0]), (50, None), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    assert run(spark, rows, {50}) == plain(rows, {50}) != []
