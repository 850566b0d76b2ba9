from __future__ import annotations

import hashlib
import math
import random
from collections import Counter
from statistics import mean

import numpy as np
import pytest
import xxhash

from material import ODD, documents
from tillhouse.llm import simhash
from tillhouse.llm.queries import QUERIES

MASK = (1 << 64) - 1
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near"]


def plain_fingerprint(text):
    """Bit by bit in Python's own integers."""
    f = [int(x) for x in simhash.FACTORS]
    words = [xxhash.xxh64_intdigest(w, simhash.SEED) for w in (text or "").encode().lower().split()]
    weights = {}
    for kind, found in ((simhash.SINGLE, Counter(words)), (1, Counter((a * f[0] + (b ^ b >> 29) * f[1]) & MASK for a, b in zip(words, words[1:])))):
        for h, n in found.items():
            weights[kind, h] = round(16 * kind * (1 + math.log(n)))
    bits = 0
    for k in range(simhash.WORDS):
        votes, total = [0] * 64, 0
        for (_, h), w in weights.items():
            x = h * f[k] & MASK
            x = (x ^ x >> 32) * f[3 - k] & MASK
            x ^= x >> 29
            total += w
            for b in range(64):
                votes[b] += w * (x >> b & 1)
        bits = bits << 64 | sum(1 << b for b in range(64) if 2 * votes[b] > total)
    return bits


def plain_edit(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def plain(items, radius=simhash.RADIUS):
    """Items in the order of documents."""
    prints = [plain_fingerprint(t) for _, t in items]
    near = lambda a, b: 1 - (a ^ b).bit_count() / 256
    out = []
    for i, (d, t) in enumerate(items):
        t, following = t or "", items[(i + 1) % len(items)][1] or ""
        edited = plain_edit(t, following)
        changed = plain_fingerprint(edited)
        n = sum(0 < (p ^ prints[i]).bit_count() <= radius for p in prints) if d is not None and d % 50 == 0 else None
        said = hashlib.sha256(edited.encode()).hexdigest()
        out.append((d, len(t), said, f"{prints[i]:064x}", f"{changed:064x}", near(prints[i], changed), near(prints[i], prints[(i + 1) % len(items)]), n))
    return sorted(out, key=str)


def rows(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    got = rows(QUERIES["op11_simhash_block_tables"](spark, sf))
    assert got == plain(sorted(documents(sf)))


def test_edited_texts_are_nearer_than_the_next(spark):
    got = [r for r in QUERIES["op11_simhash_block_tables"](spark, "/root/testdata/sf0.01").collect() if r.n_chars >= 300]
    assert mean(r.near_edited for r in got) > mean(r.near_next for r in got) + 0.1
    assert mean(r.near_edited > r.near_next for r in got) > 0.97


def test_odd_texts_null_ids_and_repeats(docs_of, spark):
    texts = [*ODD, *ODD[:3], "a last text of its own"]
    ids = [*range(0, 50 * len(ODD), 50), None, None, 0, 7]
    docs = docs_of(texts, ids, task=["x"] * len(texts), place=["y"] * len(texts), n_near=["z"] * len(texts))
    got = rows(simhash.report(docs))
    keyed = spark.createDataFrame([(d, t or "") for d, t in zip(ids, texts, strict=True)], "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(cast(text as binary)) h").collect()
    want = plain([(r.doc_id, r.text) for r in sorted(keyed, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))])
    assert got == want


@pytest.mark.parametrize(("radius", "blocks"), [(7, 8), (3, 4), (5, 8), (2, 4), (0, 2), (12, 16)])
def test_tables_find_all_within_the_radius(spark, radius, blocks):
    rng, fps = random.Random(radius), set()
    if blocks == 16:
        radius = 15  # tables of one block each
    for _ in range(6):
        centre = rng.getrandbits(256)
        for _ in range(12):
            f = centre
            for bit in rng.sample(range(256), rng.randrange(0, radius + 2)):
                f ^= 1 << bit
            fps.add(f)
    fps = sorted(fps)
    frame = spark.createDataFrame([(bytearray(f.to_bytes(32, "big")), k % 3 + 1) for k, f in enumerate(fps)], "fingerprint binary, n long")
    asked = frame.filter("n <> 2").select("fingerprint")
    got = {int.from_bytes(r.fingerprint, "big"): r.n_near for r in simhash.within(frame, asked, radius, blocks).collect()}
    want = {f: sum(j % 3 + 1 for j, g in enumerate(fps) if 0 < (f ^ g).bit_count() <= radius) for k, f in enumerate(fps) if k % 3 + 1 != 2}
    assert got == {f: n for f, n in want.items() if n}


def test_blocks_must_fit():
    for radius, blocks in ((8, 8), (3, 7), (-1, 4)):
        with pytest.raises(ValueError, match="blocks"):
            simhash.block_tables(radius, blocks)


def test_single_and_empty_tables(docs_of):
    assert rows(simhash.report(docs_of([]))) == []
    assert rows(simhash.report(docs_of(["é" * 7], [50]))) == plain([(50, "é" * 7)])
    assert rows(simhash.report(docs_of([None], [None]))) == plain([(None, None)])


def test_replaced_halves_are_of_code_points():
    for own in ("", "a", "ab", "é中😀x", "x" * 9):
        for other in ("", "z", "😀" * 9, "中é" * 3):
            n, got = simhash.replaced(own.encode(), other.encode())
            assert (n, got.decode()) == (len(own), plain_edit(own, other))


def test_order_of_terms_within_a_long_text_does_not_matter_to_sums():
    words = [f"w{i % 30000}" for i in range(60000)]
    text = " ".join(words)
    assert simhash.fingerprint(text.encode()).tolist() == simhash.fingerprint(text.upper().encode()).tolist()
    assert not np.array_equal(simhash.fingerprint(text.encode()), simhash.fingerprint(b""))
