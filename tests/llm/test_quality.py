from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import quality
from claimlake.llm.queries import op5_quality, quality_model

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality_model(spark, SF)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op5_quality(spark, SF).where("held_out").join(labels, "doc_id").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 50 and sum(right) / len(rows) > 0.95
    assert all(r.predicted == 1 for r in rows if r.quality == 1)


def test_same_scores_however_words_come(model, spark):
    texts = [r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    together = model.scores(texts)
    assert together == [model.scores([t])[0] for t in texts]

    def slow(text):
        words = text.split()
        shares = []
        for word in words:
            slots, _ = quality.word_slots([word])
            shares.append(model.logits[slots].mean())
        repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
        logit = (sum(shares) + repeats * model.logits[quality.REPEAT]) / (len(words) + repeats)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    for text, score in list(zip(texts, together, strict=True))[:20]:
        assert score == pytest.approx(slow(text), abs=1e-9)


def test_word_numbers_equal_the_softmax_of_averaged_vectors():
    random = np.random.default_rng(0)
    model = quality.Model(random.standard_normal((quality.FEATURES, quality.SIZE)), random.standard_normal((2, quality.SIZE)), 0.5)
    text = b"Some some words, WORDS! x9 x9 x9 \xc3\xa9t\xc3\xa9"
    slots, weights = quality.document_slots(text)
    out = model.layer @ (weights @ model.vectors[slots])
    assert model.scores([text])[0] == pytest.approx(np.exp(out[1]) / np.exp(out).sum(), abs=1e-5)


def test_edges(spark, model, edge_docs, edge_rows, no_docs):
    scored = quality.score_quality(edge_docs, model)
    rows = scored.collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (4, 5, 6)} == {model.prior}
    assert quality.score_quality(no_docs, model).collect() == []
    kept = quality.good_documents(edge_docs, model, 0.0)
    assert kept.schema == edge_docs.schema and kept.count() == len(edge_rows)
    nothing = quality.train(edge_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.score for r in quality.score_quality(edge_docs, nothing).collect()} == {0.5}
    few = spark.createDataFrame([(1, 1), (2, None), (7, 0), (None, 1), (4, 1), (1, 0)], "doc_id long, quality int")
    assert 0 < quality.train(edge_docs, few).prior < 1


def test_the_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = []
    original = quality.fit
    quality.fit = lambda samples: seen.append(len(samples)) or original(samples, 1)
    try:
        quality.train(docs.withColumn("quality", F.lit(7)), labels, sample=25)
    finally:
        quality.fit = original
    assert seen == [25]
