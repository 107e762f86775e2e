"""Noisy-or learning: held-out accuracy, the sentences found, and the likelihood against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairtally.llm import toxicity
from frames import no_documents, odd_documents, words

SCHEMA = "doc_id bigint, text string"


def corpus(n, seed, share=0.3):
    rng = random.Random(seed)
    docs, labels, bad = [], [], {}
    for i in range(n):
        sentences = [" ".join(words(rng, rng.randint(3, 9))).replace("0", "o") for _ in range(rng.randint(1, 12))]
        if rng.random() < share:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["zzyrk", "QUUXLE", "wozzit"]) + " end"
            bad[i] = at
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(i in bad)))
    return docs, labels, bad


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels, bad = corpus(600, 5)
    d = spark.createDataFrame(docs, SCHEMA)
    sample = toxicity.labelled_sample(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.col("doc_id") % 4 != 2)
    return d, bad, toxicity.fit(sample), docs


def test_held_out_accuracy(fitted):
    d, bad, model, docs = fitted
    scores = {r.doc_id: r.score for r in toxicity.score_documents(d, model).collect()}
    held = [i for i in scores if i % 4 == 2]
    assert sum((scores[i] >= 0.3) == (i in bad) for i in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 for s in scores.values())


def test_sentences_are_found(fitted):
    d, bad, model, docs = fitted
    found = toxicity.offending_sentences(d, model).collect()
    where = {(r.doc_id, r.sentence) for r in found}
    assert len(where & set(bad.items())) >= 0.95 * len(bad)
    assert len(where - set(bad.items())) <= 0.05 * len(bad)
    texts = dict(docs)
    assert all(texts[r.doc_id][r.start : r.end].strip() == r.text for r in found)


def test_score_is_the_noisy_or(fitted):
    """Sentence by sentence over whole texts, with features found by plain search."""
    d, bad, model, docs = fitted
    weight = dict(zip(model.features.tolist(), model.weights))

    def plain(text):
        clean = 1 - model.leak
        for start, end in toxicity.sentence_spans(text):
            sentence = text[start:end]
            if not any(c.isalpha() for c in sentence):
                continue
            # A 5-gram belongs to the sentence of its middle, and its ends may lie outside.
            around = f" {text} "[start : end + 2]
            grams = {int(h) for hs, _, _ in toxicity.pieces(around) for h in hs}
            z = model.bias + sum(weight.get(g, 0.0) for g in grams)
            clean *= 1 - 1 / (1 + math.exp(-z))
        return 1 - clean

    scores = {r.doc_id: r.score for r in toxicity.score_documents(d, model).collect()}
    for i, text in docs[:80]:
        assert scores[i] == pytest.approx(plain(text), rel=1e-6, abs=1e-9)


def test_long_texts_are_read_whole(fitted, monkeypatch):
    d, bad, model, docs = fitted
    text = "abc defgh. " * 3000 + "quuxle zzyrk. " + "hij klmno! " * 3000
    seen = toxicity.low_bits(model.features)
    whole = toxicity.bag(text, model.features, seen)
    score = toxicity.document_score(model, text, seen)
    for piece in (7, 64, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        part = toxicity.bag(text, model.features, seen)
        assert part[0] == whole[0] == 6001 and (part[1] == whole[1]).all() and (part[2] == whole[2]).all()
        assert toxicity.document_score(model, text, seen) == pytest.approx(score)
    assert score > 0.5 and set(whole[1].tolist()) == {3000}


def test_fit_climbs_the_likelihood():
    rng = np.random.default_rng(1)
    toxic = np.array([True, False] * 50)
    # Feature 0 in one sentence of each toxic document, feature 1 in a sentence of each document.
    doc = np.concatenate([np.flatnonzero(toxic), np.arange(100)])
    sentence = np.arange(150)
    feature = np.array([0] * 50 + [1] * 100)
    weights, bias, leak = toxicity.fit_bags(toxic, rng.integers(0, 9, 100).astype(float), doc, sentence, feature, 2)

    assert weights[0] > weights[1] >= 0 and weights[0] + bias > 2 and weights[1] + bias < 0 and leak < 0.1


def test_odd_rows(spark, fitted):
    model = fitted[2]
    docs = odd_documents(spark)
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == docs.count()
    blank = {4, 5, 6, 10}
    assert all(r.score == pytest.approx(model.leak) for r in rows if r.doc_id in blank)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert toxicity.offending_sentences(docs, model).where(F.col("doc_id").isin(*blank)).count() == 0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled_sample(no_documents(spark), empty))
    assert toxicity.score_documents(no_documents(spark), model).collect() == []
    docs = odd_documents(spark)
    one = spark.createDataFrame([(1, 1), (None, 1), (2, None), (1, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled_sample(docs, one))
    assert all(r.score == pytest.approx(model.leak) for r in toxicity.score_documents(docs, model).collect())


def test_sample_is_bounded(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    n = toxicity.labelled_sample(docs, labels, most=500).count()
    assert 400 < n < 600
