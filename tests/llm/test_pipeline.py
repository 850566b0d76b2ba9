from __future__ import annotations

from collections import Counter

import corpus_pipeline
from material import ODD
from tillhouse.llm import compression, factorisation, golay, packing
from tillhouse.session import written

from test_line_dedup import plain as plain_lines
from test_packing import check
from test_quality_rules import plain as plain_rules
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text").collect())


def test_stages_one_by_one_equal_brute_force(spark):
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "quality_classifier", "line_dedup", "simhash_dedup", "pack"]

    ruled = written(stages["quality_rules"](spark, docs, SF))
    bands, squeeze = compression.Bands(), zstandard.ZstdCompressor(level=3)
    good = [(r.doc_id, r.text) for r in docs.collect() if not plain_rules(r.text)[5] and compression.in_bands(r.text.encode(), bands, squeeze)[0]]
    assert rows(ruled) == Counter(good)

    sorted_out = written(stages["quality_classifier"](spark, ruled, SF))
    machine = factorisation.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    passed = {r.doc_id for r in factorisation.score(ruled, machine).filter("score >= 0.3").collect()}
    assert rows(sorted_out) == Counter((d, t) for d, t in good if d in passed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [d for d, _ in good if labels.get(d) == 1]
    assert sum(d in passed for d in clean) >= 0.98 * len(clean) > 0

    lined = written(stages["line_dedup"](spark, sorted_out, SF))
    want = plain_lines([(d, t) for d, t in good if d in passed])
    assert rows(lined) == Counter((d, t) for d, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    single = written(stages["simhash_dedup"](spark, lined, SF))
    heads = {c for _, _, c in plain_components([(d, plain_fingerprint(t)) for d, t, _ in want])}
    assert rows(single) == Counter((d, t) for d, t, _ in want if d in heads)
    assert all(df.schema == docs.schema for df in (ruled, sorted_out, lined, single))

    check(stages["pack"](spark, single, SF).collect(), {d: t for d, t, _ in want if d in heads})


def test_run_is_its_stages(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == packing.OUT


def test_stages_bear_odd_rows_and_nothing(spark, docs_of):
    prose = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(50).collect()]
    odd = docs_of([*ODD, *prose, prose[0]], [*range(len(ODD)), None, None, *range(100, 147), 100, None])
    for docs in (odd, docs_of([])):
        before = docs
        for _, stage in corpus_pipeline.STAGES:
            before = written(stage(spark, before, SF))
        assert set(before.columns) == set(packing.OUT)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).schema == odd.schema, name
    assert golay.keep_one(odd).filter("doc_id IS NULL").count() >= 1
