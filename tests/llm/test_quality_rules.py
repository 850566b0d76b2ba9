from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tillhouse.llm import compression
from tillhouse.llm.queries import QUERIES

from material import ODD, texts_at

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_base_counts_equal_brute_force(spark, docs_of):
    texts = ODD + texts_at("/root/testdata/sf0.001")
    got = compression.report(docs_of(texts)).orderBy("doc_id").collect()
    assert [tuple(r)[1:7] for r in got] == [plain(t) for t in texts]
    assert all(not r.kept for r in got if r.base_failed)


def test_query_covers_the_table_and_keeps_prose(spark, sf):
    got = QUERIES["op7_compression_bands"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.count() == docs.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = got.filter("not base_failed").join(labels.filter("quality = 1"), "doc_id")
    assert good.filter("kept").count() >= 0.98 * good.count() > 0


def test_bands_reject_repetition_and_noise():
    import zstandard

    squeeze, bands = zstandard.ZstdCompressor(level=3), compression.Bands()
    rng = random.Random(1)
    passage = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(80))
    assert not compression.in_bands(((passage + " ") * 30).encode(), bands, squeeze)[0]
    assert not compression.in_bands(bytes(rng.randrange(33, 255) for _ in range(9000)), bands, squeeze)[0]
    # half a document of noise behind prose is caught by its chunks
    prose = " ".join(rng.choice(["the", "of", "harbour", "winter", "reading", "letters", "slowly", "carried", "a", "and"]) for _ in range(900)).encode()
    assert compression.in_bands(prose + bytes(rng.randrange(33, 255) for _ in range(len(prose))), bands, squeeze)[2] > 0.25


def test_stage_keeps_columns_and_rows(spark, docs_of):
    prose = texts_at("/root/testdata/sf0.001")[:40]
    docs = docs_of(prose + ODD, kept=[str(i) for i in range(len(prose + ODD))])
    good = compression.keep_good(docs)
    assert good.schema == docs.schema
    verdicts = {r.doc_id: r.kept for r in compression.report(docs).collect()}
    assert sorted(r.doc_id for r in good.collect()) == [i for i, k in sorted(verdicts.items()) if k]


@pytest.mark.parametrize("ids", [[None, None, 1, 1]])
def test_null_ids_and_repeats(docs_of, ids):
    assert compression.report(docs_of(["a", None, "b", "b"], ids)).count() == 4


def test_empty_table(docs_of):
    assert compression.report(docs_of([])).collect() == []
    assert compression.keep_good(docs_of([])).collect() == []
