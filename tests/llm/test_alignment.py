from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from material import ODD, documents
from tillhouse.llm import alignment
from tillhouse.llm.bpe import byte_letters
from tillhouse.llm.queries import QUERIES

PATHS = public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES)
LIBRARY, LETTERS = Tokenizer.from_file(PATHS[0]), byte_letters()
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
MORE = ["<|endoftext|> a", "</s> <s> <unk> <0x41>", "a\u2581b", "  two  spaces ", " lead", "aaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキスト、漢字。", "🙂🙃" * 20, "x\0y", "é" * 50, "\t\tcode\n\n\n  if"]


def plain_tokens(text):
    """Both sides as (id, bytes), from the libraries alone; empty if either does not spell the text."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in LIBRARY.id_to_token(i))) for i in LIBRARY.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in PIECES.encode(text):
        piece = PIECES.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()))
    own = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == own == b"".join(x for _, x in b) else ([], [])


def plain_groups(a, b):
    """Both sides walked along together."""
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    left, right = [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            left.append(a[i][0])
            at_a += len(a[i][1])
            i += 1
        else:
            right.append(b[j][0])
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b and left and right:
            groups.append((left, right))
            left, right = [], []
    return groups


def plain(items):
    made = [(d, *plain_tokens(t)) for d, t in items]
    made = [(d, a, b, plain_groups(a, b)) for d, a, b in made]
    links = [Counter((x, y) for left, right in g for x in left for y in right) for _, _, _, g in made]
    counts = Counter(p for c in links for p in c)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for (d, a, b, g), c in zip(made, links, strict=True):
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        best = sum(n for p, n in c.items() if counts[p] == highest[p[0]])
        out.append((d, len(a), len(b), len(g), sum(c.values()), best, sum(n * counts[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf):
    got = QUERIES["op13_tokenizer_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == plain(documents(sf))


@pytest.mark.parametrize(("head", "limit"), [(alignment.HEAD, alignment.LINKS), (5, 3), (0, 40), (200, 1)])
def test_odd_texts_null_ids_and_repeats_whatever_the_bounds(docs_of, head, limit):
    texts = [*ODD, *MORE, "to be", "to be", None, "x" * 300 + "é" * 40]
    ids = [*range(len(texts) - 3), 3, None, None]
    docs = docs_of(texts, ids, row=["x"] * len(texts), keys=["y"] * len(texts), task=["z"] * len(texts))
    assert rows(alignment.report(docs, head=head, limit=limit)) == plain(list(zip(ids, texts, strict=True)))


def test_empty_table(docs_of):
    assert alignment.report(docs_of([])).collect() == []
    assert rows(alignment.report(docs_of([None, ""]))) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_any_texts_divide_like_a_walk_along_both(texts):
    known = alignment.load(*PATHS)
    a, b = known.encode([t.encode("utf-8", "replace") for t in texts])
    for t, x, y in zip(texts, a, b, strict=True):
        want = plain_tokens(t.encode("utf-8", "replace").decode())
        assert (x, y) == tuple([i for i, _ in side] for side in want)


def test_division_finds_every_common_end():
    rng = random.Random(3)
    for _ in range(200):
        sides, texts = ([], []), ([0], [0])
        at = 0
        for _ in range(rng.randrange(0, 5)):
            size = rng.randrange(1, 60)
            for side, ends in zip(sides, texts, strict=True):
                side.extend(sorted({at + size, *(at + rng.randrange(1, size + 1) for _ in range(rng.randrange(0, size)))}))
                ends.append(len(side))
            at += size
        a, b = (np.array(s, np.int64) for s in sides)
        end_a, end_b = alignment.divide(a, b, np.array(texts[0][1:], np.int64), np.array(texts[1][1:], np.int64))
        common = sorted(set(sides[0]) & set(sides[1]))
        assert a[end_a - 1].tolist() == b[end_b - 1].tolist() == common


def test_long_uniform_texts_are_encoded():
    known = alignment.load(*PATHS)
    for text in (" " * 300_000, "a" * 300_000, "\n" * 100_000, "ab " * 400_000):
        a, b = known.encode([text.encode()])
        assert not a[0] or b"".join(known.bytes_a[i] for i in a[0]) == b"".join(known.bytes_b[i] for i in b[0]) == b" " + text.encode()
