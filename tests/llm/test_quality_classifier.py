from __future__ import annotations

import zlib

import numpy as np
import pytest

from material import ODD
from tillhouse.llm import factorisation as fm
from tillhouse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def learned(spark):
    sf = "/root/testdata/sf0.01"
    return fm.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_query_scores_all_and_holds_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_factorisation_machine"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) >= 0.95
    assert np.mean([p for p, q in held if q]) >= 0.98


def test_linear_time_sum_equals_all_pairs(learned):
    features = fm.Features()
    rows = [features(t, None) for t in (b"the cat sat on the mat", b"A | b | c", b"")]
    index, value, starts = learned.features(rows)
    raw = learned.raw(index, value, starts)[0]
    for r, (a, b) in enumerate(zip(starts, [*starts[1:], len(index)], strict=True)):
        own, x = index[a:b], value[a:b].astype(float)
        pairs = sum(learned.vectors[own[i]] @ learned.vectors[own[j]] * x[i] * x[j] for i in range(len(own)) for j in range(i))
        assert raw[r] == pytest.approx(learned.bias + learned.weight[own] @ x + pairs, abs=1e-3)


def test_ids_labels_and_sources_are_no_inputs(spark, docs_of, learned):
    one = fm.score(docs_of(["some words here", "others"]), learned).orderBy("doc_id").collect()
    two = fm.score(docs_of(["some words here", "others"], [70, 80], label=["1", "0"]), learned).orderBy("doc_id").collect()
    assert [r.score for r in one] == [r.score for r in two]


def test_held_out_labels_are_not_learned(spark, docs_of):
    texts = [f"text number {i} of many" for i in range(60)]
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    one, two = fm.learn(docs, labels), fm.learn(docs, flipped)
    assert np.array_equal(one.weight, two.weight) and np.array_equal(one.vectors, two.vectors)
    assert {r.doc_id for r in fm.sample(docs, labels).collect()} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 5}


def test_odd_texts_stage_and_empty_tables(spark, docs_of, learned):
    docs = docs_of([*ODD, "x", "x"], [*range(len(ODD)), None, None], score=["a"] * (len(ODD) + 2))
    got = fm.score(docs, learned).collect()
    assert len(got) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in got)
    good = fm.keep_good(docs, learned)
    assert good.schema == docs.schema
    assert sorted(str(r.doc_id) for r in good.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)
    assert fm.score(docs_of([]), learned).collect() == [] == fm.keep_good(docs_of([]), learned).collect()
    blank = fm.learn(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.score for r in fm.score(docs, blank).collect()} == {0.5}


def test_repeated_ids_and_long_texts_are_one_row_each_of_the_sample(spark, docs_of):
    long = "very long " * 30_000  # over 200,000 characters
    texts = [f"text number {i}" for i in range(40)] + [long] + [f"copy {k} of one id" for k in range(200)]
    docs = docs_of(texts, [*range(40), 77, *[5] * 200])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [*range(40), 77]], "doc_id long, quality int, toxic int")
    got = fm.sample(docs, labels).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i in [*range(40), 77] if zlib.crc32(str(i).encode()) % 5)
    assert any(r.text == long for r in got) == bool(zlib.crc32(b"77") % 5)
    one, two = fm.learn(docs, labels), fm.learn(docs.repartition(7), labels)
    assert np.array_equal(one.weight, two.weight) and np.array_equal(one.vectors, two.vectors)
