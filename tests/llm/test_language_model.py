from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from material import ODD, documents
from tillhouse.llm import language_model as lm
from tillhouse.llm.queries import QUERIES


def plain(items):
    """Base figures of (id, text) pairs."""
    words = [[*(t or "").encode().lower().split(), lm.END] for _, t in items]
    outside = [None if d is None else zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in items]
    counts = Counter(w for ws, o in zip(words, outside, strict=True) if o is False for w in ws)
    n, v = sum(counts.values()), len(counts)
    for (d, _), ws, o in zip(items, words, outside, strict=True):
        yield d, o, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)


def same(got, items):
    got = sorted((tuple(r)[:6] for r in got), key=str)
    want = sorted(plain(items), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op2_recurrent_language_model"](spark, "/root/testdata/sf0.001").collect()


def test_base_equals_brute_force(scored, sf):
    same(scored, documents(sf))


def test_beats_the_base_on_held_out_documents(scored):
    held = [r for r in scored if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def tiny():
    words = [lm.END, *(f"w{i}".encode() for i in range(30))]
    counts = np.arange(60, 60 - len(words), -1)
    known = lm.Vocabulary(
        {w: i for i, w in enumerate(words)}, counts, 1, int(counts.sum()), len(words), 20, lm.class_bounds(counts[:20], 4),
        {lm.shape(b"w29"): 0}, np.log10(np.array([5.0] * lm.SHAPES)),
    )
    return known, lm.Network.new(known)


def test_probabilities_add_up():
    known, network = tiny()
    h = np.random.default_rng(0).normal(0, 0.5, (1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(known.inputs)
    logs = network.log_probability(np.repeat(h, len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_equal_differences():
    known, network = tiny()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    rng = np.random.default_rng(1)
    x, target = rng.integers(0, known.inputs, (5, 3)), rng.integers(0, known.inputs, (5, 3))
    begins, h = rng.random((5, 3)) < 0.3, rng.normal(0, 0.3, (3, lm.HIDDEN))
    _, g, _ = network.window(x, target, begins, h)
    for name, value in network.p.items():
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(4)]:
            kept, step = value[at], 1e-2 if name in ("wx", "u") else 1e-3
            value[at] = kept + step
            up = network.window(x, target, begins, h)[0]
            value[at] = kept - step
            down = network.window(x, target, begins, h)[0]
            value[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(g[name][at], abs=2e-4)


def test_lanes_and_windows_do_not_matter(monkeypatch):
    known, network = tiny()
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, known.inputs, n), 0).astype(np.int32) for n in (0, 3, 200, 1, 47, 90, 5)]
    alone = np.array([lm.score_documents(network, [d])[0] for d in docs])
    monkeypatch.setattr(lm, "LANES", 2)
    assert np.allclose(lm.score_documents(network, docs), alone, rtol=1e-4)


def test_head_is_cut_at_a_frequency_and_the_rest_joined(docs_of, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 12)
    items = [(i, " ".join(f"w{k % (3 + i)}" for k in range(40)) + " rare%d" % i) for i in range(30)]
    same(lm.score(docs_of([t for _, t in items])).collect(), items)


def test_odd_texts_null_ids_and_repeats(docs_of):
    items = [*enumerate(ODD), (3, "one"), (None, "one two"), (None, None)]
    got = lm.score(docs_of([t for _, t in items], [d for d, _ in items], word=["x"] * len(items), row=["y"] * len(items))).collect()
    same(got, items)
    assert all(math.isfinite(r.score) for r in got)


def test_empty_tables(docs_of):
    assert lm.score(docs_of([])).collect() == []
    (only,) = lm.score(docs_of(["no one learns this"], [None])).collect()
    assert (only.held_out, only.n_tokens, only.n_known, only.train_tokens, only.base_score) == (None, 5, 0, 0, 0.0)


def test_texts_are_read_for_counts_and_ids_alone(docs_of, monkeypatch):
    read, plain = [], lm.map_texts
    monkeypatch.setattr(lm, "map_texts", lambda docs, columns, *rest: read.append("text" in columns) or plain(docs, columns, *rest))
    items = [*enumerate(["a b c", "b c d e"] * 9)]
    same(lm.score(docs_of([t for _, t in items])).collect(), items)
    assert sum(read) == 2


def test_probabilities_of_large_weights_add_up():
    known, network = tiny()
    network.p["wc"] *= 3000
    network.p["wo"] *= 3000
    h = np.full((known.inputs, lm.HIDDEN), 0.9, np.float32)
    logs = network.log_probability(h, np.arange(known.inputs))
    assert np.isfinite(logs).all() and np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
