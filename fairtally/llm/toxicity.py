"""Toxicity by multiple-instance learning: labels of documents teach scores of sentences.

A sentence is toxic with probability p = sigmoid(bias + weights of its distinct character 5-grams). A
document is toxic unless all its sentences are clean and no unseen cause labelled it (noisy-or with
leak): 1 - (1 - leak) * product(1 - p). The fit maximises the likelihood of the documents' labels;
the sentence scores then tell where the offence is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored
from fairtally.llm.langid import _folded as folded_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 5
#: Labelled documents that a model is fitted on (about; a seeded hash of doc_id picks them): a fixed bound.
MOST_LABELLED = 20_000
#: Toxic documents that must have a 5-gram, those looked at at most, and those kept in the model at most.
LEAST_TOXIC, MOST_CANDIDATES, MOST_FEATURES = 3, 65_536, 4_096
#: A kept 5-gram is surely (deviations) and clearly (log odds) more frequent among toxic documents.
LEAST_Z, LEAST_ODDS = 3.0, 1.0
ROUNDS, RATE, RIDGE = 400, 0.1, 1e-3
PIECE = 1 << 18
SENTENCE_ENDS = ".!?\n"


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted hashes of the 5-grams with their weights; ``bias`` of a sentence; ``leak`` of a document."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float


def pieces(text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per stretch of a text: 5-gram hashes, the sentence of each, and the sentences that have a letter.

    A 5-gram lies in one word, or in one word and the blank before or behind it: its middle three
    are letters. Stretches overlap by as much as a 5-gram needs, so where they are cut shows nowhere.
    """
    table = folded_letters()
    ends_of = np.frombuffer(SENTENCE_ENDS.encode("utf-32-le"), np.uint32)
    padded, base, last = f" {text} ", 0, -1
    for start in range(0, len(padded), PIECE):
        raw = np.frombuffer(padded[start : start + PIECE + GRAM - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(PIECE, len(raw))
        ends = np.isin(raw, ends_of)
        sentence = base + np.cumsum(ends) - ends
        codes = table[raw].astype(np.uint64)
        letter = codes != 32
        lettered = np.unique(sentence[:own][letter[:own]])
        fresh = lettered[lettered > last]
        last = max(last, int(lettered[-1]) if len(lettered) else -1)
        n = len(raw) - GRAM + 1
        if n > 0:
            h = codes[:n].copy()
            for k in range(1, GRAM):
                h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
            h ^= h >> np.uint64(29)
            whole = letter[1 : n + 1] & letter[2 : n + 2] & letter[3 : n + 3]
            whole[own:] = False
            yield h[whole], sentence[2 : n + 2][whole], fresh
        else:
            yield np.empty(0, np.uint64), np.empty(0, np.int64), fresh
        base += int(ends[:own].sum())


def _places(features: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into ``h`` of the known 5-grams, and which feature each is."""
    if not len(features):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(features, h), len(features) - 1)
    known = np.flatnonzero(features[at] == h)
    return known, at[known]


def bag(text: str | None, features: np.ndarray, seen: np.ndarray | None = None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of sentences with a letter, and the distinct (sentence, feature) pairs of a text.

    ``seen`` is a bitmap over the low 16 bits of the features, which spares most lookups.
    """
    count, sentences, found = 0, [], []
    for h, sentence, fresh in pieces(text or ""):
        count += len(fresh)
        if seen is not None:
            maybe = np.flatnonzero(seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
            h, sentence = h[maybe], sentence[maybe]
        known, feature = _places(features, h)
        sentences.append(sentence[known])
        found.append(feature)
    pairs = np.unique(np.concatenate(sentences) * np.int64(MOST_CANDIDATES) + np.concatenate(found))
    return count, pairs // MOST_CANDIDATES, pairs % MOST_CANDIDATES


def low_bits(features: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 16, bool)
    seen[(features & np.uint64(0xFFFF)).astype(np.int64)] = True
    return seen


def _toxic_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): number of documents of each batch that have a 5-gram."""
    for batch in batches:
        each = [np.unique(np.concatenate([h for h, _, _ in pieces(t.as_py() or "")])) for t in batch.column("text")]
        if each:
            grams, n = np.unique(np.concatenate(each), return_counts=True)
            yield pa.record_batch({"gram": pa.array(grams.view(np.int64)), "n": pa.array(n, pa.int64())})


def _known_grams(features: np.ndarray):
    """(feature, n): number of a task's documents that have a feature; feature -1 counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, seen = np.zeros(len(features), np.int64), 0, low_bits(features)
        for batch in batches:
            for t in batch.column("text"):
                total[np.unique(bag(t.as_py(), features, seen)[2])] += 1
                n += 1
        yield pa.record_batch(
            {"feature": pa.array(np.arange(-1, len(total)), pa.int64()), "n": pa.array(np.concatenate([[n], total]), pa.int64())}
        )

    return run


def _bags(features: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = low_bits(features)
        for batch in batches:
            found = [bag(t.as_py(), features, seen) for t in batch.column("text")]
            yield pa.record_batch(
                {
                    "toxic": batch.column("toxic"),
                    "n": pa.array([f[0] for f in found], pa.int64()),
                    "sentence": pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    "feature": pa.array([f[2].astype(np.int32) for f in found], pa.list_(pa.int32())),
                }
            )

    return run


def labelled_sample(documents: DataFrame, labels: DataFrame, train: Column | None = None, most: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic boolean) of about ``most`` labelled documents at most, written once.

    ``train`` is a condition on doc_id of the labels. Rows without doc_id or label are left out; a
    document labelled more than once is toxic if any label says so. Repeated rows of a document count
    each. The picked labels are few by their bound, so the texts are not shuffled.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if train is not None:
        rows = rows.where(train)
    known = rows.groupBy(F.col("doc_id").alias("id")).agg((F.max(F.col("toxic").cast("int")) == 1).alias("toxic"))
    n = known.count()
    rate = min(1.0, most / max(n, 1))
    # The hash is even over 2**64 values: this picks rate * n documents, give or take a few per cent.
    few = known if rate == 1.0 else known.where(F.xxhash64("id", F.lit(13)) < F.lit(int((rate - 0.5) * 2.0**64)))
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.join(F.broadcast(few), F.col("_id") == F.col("id")).select("text", "toxic"), "labelled-texts")


def _select(sample: DataFrame) -> np.ndarray:
    """5-grams that speak for toxic documents, by the log odds of their document shares."""
    counted = sample.where("toxic").select("text").mapInArrow(_toxic_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") >= LEAST_TOXIC).orderBy(F.desc("n"), "gram").limit(MOST_CANDIDATES).collect()
    grams = np.array([r["gram"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(grams)
    grams, toxic = grams[order], np.array([r["n"] for r in often], float)[order]
    clean = np.zeros(len(grams) + 1)
    sums = sample.where("NOT toxic").select("text").mapInArrow(_known_grams(grams), "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # one row for each candidate at most
        clean[r["feature"]] = r["n"]  # the number of documents comes last, as feature -1
    n_clean, clean = clean[-1], clean[:-1]
    n_toxic = sample.where("toxic").count()
    odds = np.log((toxic + 0.5) / (n_toxic - toxic + 0.5)) - np.log((clean + 0.5) / (n_clean - clean + 0.5))
    z = odds / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    best = np.lexsort((grams, -z))
    best = best[(z[best] > LEAST_Z) & (odds[best] > LEAST_ODDS)]
    return np.sort(grams[best[:MOST_FEATURES]])


def fit_bags(toxic: np.ndarray, plain: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, n_features: int):
    """(weights, bias, leak) of greatest likelihood, by Adam with a small ridge on the weights.

    ``toxic`` and ``plain`` (sentences without a feature) are per document; ``doc`` is the document of
    each other sentence; (``sentence``, ``feature``) are their pairs. Weights stay above 0: a sentence
    offends by what it has.
    """
    w, b, c = np.zeros(n_features), -6.0, -3.0
    n = max(len(toxic), 1)
    first, second = np.zeros(n_features + 2), np.zeros(n_features + 2)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for step in range(1, ROUNDS + 1):
        z = b + np.bincount(sentence, w[feature], len(doc))
        log_clean = np.log1p(-sigmoid(c)) - plain * np.logaddexp(0, b) - np.bincount(doc, np.logaddexp(0, z), len(toxic))
        # Of a toxic document d(-log(1 - Q))/d(log Q) = Q / (1 - Q); of a clean one it is -1.
        slope = np.where(toxic, 1 / np.expm1(np.maximum(-log_clean, 1e-9)), -1.0) / n
        p, p0 = sigmoid(z), sigmoid(b)
        by_sentence = -slope[doc] * p
        gradient = np.concatenate(
            [
                np.bincount(feature, by_sentence[sentence], n_features) + RIDGE * w / n,
                [by_sentence.sum() - (slope * plain).sum() * p0, -slope.sum() * sigmoid(c)],
            ]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b, c = np.maximum(w - move[:-2], 0.0), float(min(b - move[-2], 0.0)), float(c - move[-1])
    return w, b, float(sigmoid(c))


def fit(sample: DataFrame) -> ToxicityModel:
    """A model from (text, toxic) rows, a table bounded as by ``labelled_sample``.

    Their 5-grams are counted and chosen on Spark; the driver gets the chosen ones' places in the
    sentences and climbs the likelihood. Without toxic or without clean rows there is nothing to tell
    apart: the model has no features and its leak is the smoothed share of toxic rows.
    """
    features = _select(sample)
    rows = sample.mapInArrow(_bags(features), "toxic boolean, n bigint, sentence array<int>, feature array<int>").toArrow()
    toxic = rows["toxic"].to_numpy().astype(bool)
    if not len(features) or toxic.all() or not toxic.any():
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), -60.0, float((toxic.sum() + 0.5) / (len(toxic) + 1)))
    doc, sentence, feature, plain = [], [], [], rows["n"].to_numpy().astype(float)
    at = 0
    for i, (s, f) in enumerate(zip(rows["sentence"], rows["feature"])):
        s, f = s.values.to_numpy(), f.values.to_numpy()
        if len(s):
            own, place = np.unique(s, return_inverse=True)
            doc.append(np.full(len(own), i))
            sentence.append(at + place)
            feature.append(f)
            plain[i] = max(0.0, plain[i] - len(own))
            at += len(own)
    weights, bias, leak = fit_bags(toxic, plain, np.concatenate(doc), np.concatenate(sentence), np.concatenate(feature), len(features))
    used = weights > 0
    return ToxicityModel(features[used], weights[used], bias, leak)


def _sentence_odds(model: ToxicityModel, text: str | None, seen: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of sentences with a letter; those that have a feature, and their log odds."""
    n, sentence, feature = bag(text, model.features, seen)
    own, place = np.unique(sentence, return_inverse=True)
    return n, own, model.bias + np.bincount(place, model.weights[feature], len(own))


def document_score(model: ToxicityModel, text: str | None, seen: np.ndarray) -> float:
    n, own, z = _sentence_odds(model, text, seen)
    log_clean = np.log1p(-model.leak) - max(0, n - len(own)) * np.logaddexp(0, model.bias) - np.logaddexp(0, z).sum()
    return float(min(1.0, max(0.0, -np.expm1(log_clean))))


def score_documents(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score): the probability that a document is toxic, from its whole text and nothing else.

    Null, empty and letterless texts have no sentences: their score is the leak. Repeated rows score
    the same each; a null doc_id stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = low_bits(model.features)
        for batch in batches:
            scores = [document_score(model, t.as_py(), seen) for t in batch.column("text")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Start and end, in code points, of each sentence by its number; the end mark belongs to it."""
    spans, start = [], 0
    for i, c in enumerate(text):
        if c in SENTENCE_ENDS:
            spans.append((start, i + 1))
            start = i + 1
    return [*spans, (start, len(text))]


def offending_sentences(documents: DataFrame, model: ToxicityModel, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, start, end, score, text): the sentences whose own score is at least ``least``.

    ``sentence`` counts from 0 over the ends ``. ! ?`` and line feeds; start and end are code points
    in the document's text. Texts without sentences give no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = low_bits(model.features)
        for batch in batches:
            rows = []
            for key, value in zip(batch.column("doc_id"), batch.column("text")):
                text = value.as_py() or ""
                _, own, z = _sentence_odds(model, text, seen)
                p = 1 / (1 + np.exp(-z))
                if (p >= least).any():
                    spans = sentence_spans(text)
                    rows += [(key.as_py(), int(s), *spans[s], float(q), text[slice(*spans[s])].strip()) for s, q in zip(own, p) if q >= least]
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string())
            names = ("doc_id", "sentence", "start", "end", "score", "text")
            yield pa.record_batch({name: pa.array(x, kind) for name, x, kind in zip(names, columns, kinds)})

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, sentence bigint, start bigint, end bigint, score double, text string")
