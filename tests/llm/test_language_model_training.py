from __future__ import annotations

import numpy as np
import pytest

from tillhouse.llm import language_model as lm


def total(docs):
    return sum(len((r.text or "").encode().lower().split()) + 1 for r in docs.collect())


@pytest.mark.parametrize("tasks", [1, 5])
def test_every_token_of_every_document_is_learned_from(spark, docs_of, tasks):
    texts = [f"a{i % 7} b c{i % 3}" for i in range(1700)] + ["long text " * 25_000, None, ""]  # more than 1,500 documents, one over 200,000 characters
    docs = docs_of(texts).repartition(tasks, "doc_id")
    known = lm.vocabulary(lm.count_words(docs))
    start = lm.Network.new(known).p
    p, tokens = lm.train_round(docs, known, start, 0, known.total / tasks)
    assert tokens == total(docs) == known.total
    assert all(p[k].shape == v.shape and np.isfinite(p[k]).all() and (p[k] != v).any() for k, v in start.items())


def test_a_long_text_alone_teaches_its_words(spark, docs_of):
    docs = docs_of(["to be or not " * 20_000])
    known, network = lm.learn(docs, lm.count_words(docs))
    ids = lm.to_ids(b"to be or not " * 20, known)[1]
    assert lm.score_documents(network, [ids])[0] > 0.5 * lm.score_documents(lm.Network.new(known), [ids])[0]


def test_tasks_beat_the_start_on_other_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter(lm.fold() != 1).repartition(4, "doc_id")
    held = spark.read.parquet(f"{sf}/documents.parquet").filter(lm.fold() == 1).collect()
    known, network = lm.learn(docs, lm.count_words(docs))
    ids = [lm.to_ids((r.text or "").encode(), known)[1] for r in held]
    start = lm.Network.new(known)
    averaged = lm.Network(lm.train_round(docs, known, start.p, 0, known.total / 4)[0], start.bounds, start.class_of)
    assert lm.score_documents(averaged, ids).sum() > lm.score_documents(start, ids).sum()
    assert lm.score_documents(network, ids).sum() > lm.score_documents(lm.Network.new(known), ids).sum() + 0.1 * sum(map(len, ids))


@pytest.mark.parametrize("enough", [0, 1 << 20])
def test_a_corpus_of_any_size_is_gone_over_again_as_a_whole(docs_of, monkeypatch, enough):
    learned, plain = [], lm.train_marked
    monkeypatch.setattr(lm, "ENOUGH", enough)
    monkeypatch.setattr(lm, "train_marked", lambda *rest: learned.append(plain(*rest)) or learned[-1])
    docs = docs_of([f"a{i % 7} b c{i % 3}" for i in range(300)] + [None])
    known, _ = lm.learn(docs, lm.count_words(docs))
    first, second, *again = [tokens for _, tokens in learned]
    assert first + second == known.total and again and set(again) == {known.total}
