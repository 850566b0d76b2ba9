from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from material import ODD, documents
from tillhouse.llm import packing
from tillhouse.llm.queries import QUERIES

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts_by_id):
    """Every id of every document lies in one piece, and sequences have no gap."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts_by_id)
    for doc_id, pieces in by_doc.items():
        ids, at = ids_of(texts_by_id[doc_id]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.CAPACITY
    return by_sequence


def test_words_equal_the_library():
    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    raw = [(t or "").encode() for t in ODD]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(raw)] == [ids_of(t)[:-1] for t in ODD]


def test_cuts_waste_little():
    for n in range(1, 3 * packing.CAPACITY):
        cut = packing.cuts(n)
        assert sum(length for length, _ in cut) == n
        for length, kind in cut:
            assert length * kind <= packing.CAPACITY
            assert packing.CAPACITY - length * kind <= max(packing.SLACK * packing.CAPACITY, kind)


def test_query_packs_all_documents(spark, sf):
    sequences = check(QUERIES["op1_harmonic_packing"](spark, sf).collect(), dict(documents(sf)))
    used = sum(p.length for s in sequences.values() for p in s)
    assert used >= 0.98 * packing.CAPACITY * (len(sequences) - 1)


def test_odd_texts(docs_of):
    check(packing.pack(docs_of(ODD, class_=["x"] * len(ODD))).collect(), dict(enumerate(ODD)))


def test_shares_fill_by_themselves_and_their_rests_meet(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARE", 60)
    texts = {i: "the cat sat on the mat " * (1 + i * 37 % 300) for i in range(300)}
    sequences = check(packing.pack(docs_of(list(texts.values()))).collect(), texts)
    used = sum(p.length for s in sequences.values() for p in s)
    assert used >= 0.95 * packing.CAPACITY * (len(sequences) - 1)
    assert len({p.sequence_id >> 59 for s in sequences.values() for p in s}) >= 3


def test_repeats_null_ids_and_empty_table(docs_of):
    rows = packing.pack(docs_of(["a b", "a b", None, "c"], [1, 1, None, None])).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.pack(docs_of([])).collect() == []


def test_plain_words_are_merged_without_the_steps_before(monkeypatch):
    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["straße größer, élèvent! ÿ ñandú... zzqxv", "aå×b ÷ Öl ÖL naïve's don't ét café́ ŉ İ ß", "été, " * 3 + "xyzzyö" * 40, "".join(map(chr, range(1, 700)))]
    texts += [f"w{chr(c)} {chr(c)}, {chr(c)}b" for c in range(33, 0x250)]
    seen = []
    slow = words.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **known):
            seen.extend(texts)
            return slow.encode_batch_fast(texts, **known)

    monkeypatch.setattr(words, "tokenizer", Watched())
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode([t.encode() for t in texts])] == [ids_of(t)[:-1] for t in texts]
    assert not {"straße", "größer", "größer,", "élèvent", "zzqxv", "été", "été,"} & set(seen)
    assert {",", "don't"} <= set(seen)


def test_a_word_with_marks_takes_its_stem_from_the_older_cache():
    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    words.encode([b"hello, W\xc3\xb6rter"])
    words.older, words.fresh, asked, plain = words.fresh, {}, set(), words._learn_plain
    words._learn_plain = lambda some: asked.update(some) or plain(some)
    text = "hello! w\u00f6rter, HELLO, \u00f6l naïve;"
    got = words.encode([text.encode()])
    assert asked == {b"!", "\u00f6l".encode(), "naïve".encode(), b";"}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(got[0], "<u4").tolist() == whole


def test_words_are_looked_up_once_and_new_ones_merged_alone(monkeypatch):
    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "CACHE", 4)
    asked, plain = [], words._learn_plain
    words._learn_plain = lambda some: asked.append(set(some)) or plain(some)
    texts = ["one two, two. zzqxv", "two! one, " + "y" * 80, "three zzqxv, größer. " + "y" * 80, "one größer two, <|x|>, é"]
    for t in texts:
        (got,) = words.encode([t.encode()])
        assert np.frombuffer(got, "<u4").tolist() == ids_of(t)[:-1]
    assert asked[1] == {b"!", b"y" * 80}  # known words and marks come from the older cache
    assert asked[2] == {b"three", b"zzqxv", "größer".encode(), b".", b"y" * 80}  # two turns ago, or too long for it


def test_a_failure_leaves_no_word_half_learned(monkeypatch):
    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    plain = words._learn_plain
    words._learn_plain = lambda some: 1 / 0
    with pytest.raises(ZeroDivisionError):
        words.encode([b"one two,"])
    words._learn_plain = plain
    assert np.frombuffer(words.encode([b"one two,"])[0], "<u4").tolist() == ids_of("one two,")[:-1]
