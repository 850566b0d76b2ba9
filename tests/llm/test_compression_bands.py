from __future__ import annotations

import pytest

from tillhouse.llm import compression
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def verdicts(spark):
    """Quality, verdict and ratio of the labelled documents that pass the base rules."""
    got = QUERIES["op7_compression_bands"](spark, SF).filter("not base_failed")
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("quality", "kept").collect()
    return {q: [r.kept for r in rows if r.quality == q] for q in (0, 1)}


def test_labelled_junk_is_rejected_and_clean_documents_stay(verdicts):
    assert sum(not k for k in verdicts[0]) >= 0.4 * len(verdicts[0]) > 0
    assert sum(verdicts[1]) >= 0.99 * len(verdicts[1]) > 0


def test_words_that_carry_symbols_are_out_of_the_bands(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id IN (4314, 5311)")
    assert [(r.base_failed, r.kept) for r in compression.report(docs).collect()] == [(False, False)] * 2


def test_the_limits_are_the_fences_of_all_documents(spark):
    bands = compression.Bands()
    got = compression.measured(spark.read.parquet(f"{SF}/documents.parquet"), bands)
    for have, want in zip([*got.whole, (0, *got.chunk_limits)], [*bands.whole, (0, *bands.chunk_limits)], strict=True):
        assert have == pytest.approx(want, abs=0.003)


def test_measured_from_nothing_changes_nothing(docs_of):
    assert compression.measured(docs_of([])) == compression.Bands()


def test_the_end_of_a_text_is_judged(spark):
    import zstandard

    squeeze, bands = zstandard.ZstdCompressor(level=3), compression.Bands()
    row = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").filter("length(text) > 4100").orderBy("doc_id").first()
    prose = row.text.encode()[:2100]
    noise = bytes(range(33, 253)) * 9
    text = prose + noise[: 4000 - len(prose)]
    assert len(text) == 4000
    assert compression.in_bands(text, bands, squeeze)[2] == 0.5
    for size, chunks in ((2047, 0), (2048, 1), (2049, 2), (4096, 2), (4097, 3)):
        assert len(compression.ratios(b"x" * size, bands, squeeze)[1]) == chunks
