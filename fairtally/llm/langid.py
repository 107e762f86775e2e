"""Language of a text by the nearest of several centroids per language, over character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fairtally.llm.common import slices, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
DIMS = 4096
ORDERS = (1, 2, 3)
CENTROIDS = 3
#: Texts per language from which centroids and distances are fitted: a fixed bound.
SAMPLE_PER_LANGUAGE = 1000
MOST_LANGUAGES = 500
BUCKETS = 24
REJECT_SHARE = 0.5
#: A part of a batch: text, and texts, whose counts are DIMS numbers each however short they are.
PART_BYTES, PART_ROWS = 1 << 20, 256

_tables: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code point to its lower-case letter, or to a blank (32) for anything that is no letter."""
    if not _tables:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _tables.append(table)
    return _tables[0]


def gram_counts(texts: list[str | None], dims: int) -> np.ndarray:
    """Counts (texts x dims) of hashed 1- to 3-grams of letters; runs of other characters are one blank."""
    table, counts = _folded(), np.zeros((len(texts), dims), np.float32)
    for row, text in enumerate(texts):
        if not text:
            continue
        codes = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = codes == 32
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        codes = np.concatenate([[np.uint32(32)], codes[keep], [np.uint32(32)]]).astype(np.uint32)
        gram = codes * np.uint32(0x9E3779B1)
        found = [gram[codes != 32]]
        if not len(found[0]):
            continue
        for n in ORDERS[1:]:
            gram = (gram[:-1] ^ (gram[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1 :] * np.uint32(0x9E3779B1)
            found.append(gram)
        mixed = np.concatenate(found)
        mixed = (mixed ^ (mixed >> np.uint32(16))) * np.uint32(0xC2B2AE35)
        counts[row] = np.bincount((mixed >> np.uint32(8)) % np.uint32(dims), minlength=dims)
    return counts


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def length_bucket(counts: np.ndarray) -> np.ndarray:
    """Bucket of the number of n-grams, a new one at each doubling."""
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int), BUCKETS - 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # unit vectors
    idf: np.ndarray
    least: np.ndarray  # similarity below which a text of a length bucket is rejected


def _document_frequencies(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES, PART_ROWS):
                counts = gram_counts(part.column("text").to_pylist(), dims)
                df += (counts > 0).sum(axis=0)
                n += part.num_rows
        # Dimension -1 holds the number of texts.
        yield pa.record_batch({"dim": pa.array(np.arange(-1, dims), pa.int32()), "df": pa.array(np.concatenate([[n], df]), pa.int64())})

    return run


def _centroids(idf: np.ndarray, k: int):
    """Spherical k-means of one language's sample; also the similarity of each text, by length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        counts = gram_counts(list(pdf["text"]), len(idf))
        lang, counts = pdf["lang"].iloc[0], counts[counts.any(axis=1)]
        if not len(counts):
            return pd.DataFrame({"lang": [], "centroid": [], "buckets": [], "similar": []})
        x = unit_vectors(counts, idf)
        chosen = [0]
        for _ in range(min(k, len(x)) - 1):  # the text least like those chosen is the next start
            chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
        centers = x[chosen]
        for _ in range(15):
            near = (x @ centers.T).argmax(axis=1)
            means = [x[near == j].mean(axis=0) if (near == j).any() else centers[j] for j in range(len(centers))]
            centers = np.stack(means)
            centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        similar = (x @ centers.T).max(axis=1)
        buckets = length_bucket(counts)
        # The lists of the sample travel with the first centroid only.
        rows = [(lang, c.astype(np.float32).tolist(), buckets.tolist() if j == 0 else [], similar.tolist() if j == 0 else []) for j, c in enumerate(centers)]
        return pd.DataFrame(rows, columns=["lang", "centroid", "buckets", "similar"])

    return run


def fit(
    documents: DataFrame, dims: int = DIMS, k: int = CENTROIDS, sample: int = SAMPLE_PER_LANGUAGE, reject_share: float = REJECT_SHARE
) -> LanguageModel:
    """Learns from ``text`` and non-null ``lang`` of all given rows.

    Document frequencies cover every row. Centroids and distances come from at most ``sample``
    texts per language, those with the smallest hash of doc_id. A text is rejected when it is less
    similar to its best centroid than ``reject_share`` times what 99 of 100 sampled texts of its
    length reach; lengths that the sample hardly shows reject nothing. Raises beyond
    ``MOST_LANGUAGES`` values of lang; no labelled rows give a model that knows no language.
    """
    known = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    parts = known.select("text").mapInArrow(_document_frequencies(dims), "dim int, df bigint")
    totals = {r["dim"]: r["n"] for r in parts.groupBy("dim").agg(F.sum("df").alias("n")).collect()}
    n = totals.get(-1) or 0
    df = np.array([totals.get(i) or 0 for i in range(dims)], float)
    idf = np.log((1 + n) / (1 + df)) + 1
    order = F.xxhash64("doc_id")
    ids = known.select("lang", "doc_id", order.alias("order"))
    ranked = ids.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id")))
    picked = stored(ranked.where(F.col("r") <= sample).select("doc_id", "lang", "order").distinct(), "language-sample")
    # At most sample rows per language: small by its parameters.
    small = F.broadcast(picked.withColumnsRenamed({"doc_id": "id", "lang": "picked_lang"}))
    texts = known.join(small, known.doc_id.eqNullSafe(F.col("id")) & (known.lang == F.col("picked_lang"))).select("lang", "text", "order")
    rows = (
        texts.groupBy("lang")
        .applyInPandas(_centroids(idf, k), "lang string, centroid array<float>, buckets array<int>, similar array<double>")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    if len({r["lang"] for r in rows}) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    buckets = np.array([b for r in rows for b in r["buckets"]], int)
    similar = np.array([s for r in rows for s in r["similar"]], float)
    least = np.zeros(BUCKETS)
    for b in range(BUCKETS):
        own = similar[buckets == b]
        if len(own) >= 30:
            least[b] = reject_share * np.quantile(own, 0.01)
    centroids = np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), dims)
    return LanguageModel([r["lang"] for r in rows], centroids, idf.astype(np.float32), least)


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_columns == 1:  # the row holds the text
                batch = batch.append_column("text", batch.column("row").field("text"))
            for part in slices(batch, "text", PART_BYTES, PART_ROWS):
                counts = gram_counts(part.column("text").to_pylist(), len(model.idf))
                letters = counts.any(axis=1)
                if model.languages:
                    similar = unit_vectors(counts, model.idf) @ model.centroids.T
                    best, score = similar.argmax(axis=1), np.clip(similar.max(axis=1), 0.0, 1.0)
                    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
                else:
                    score, names = np.zeros(part.num_rows), [UNKNOWN] * part.num_rows
                score = np.where(letters, score, 0.0)
                rejected = (names == np.array(UNKNOWN)) | (score < model.least[length_bucket(counts)])
                yield pa.record_batch(
                    {
                        "row": part.column("row"),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(score.astype(float), pa.float64()),
                        "rejected": pa.array(rejected, pa.bool_()),
                    }
                )

    return run


def identify(documents: DataFrame, model: LanguageModel, keep_row: bool = False) -> DataFrame:
    """Per row: ``row`` (doc_id, or all columns with ``keep_row``), lang_pred, score, rejected.

    Reads whole texts and nothing else. Null, empty or letterless texts are ``und`` with score 0 and
    rejected; ties go to the first language by name; repeated rows give equal results.
    """
    kept = documents.columns if keep_row else ["doc_id"]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    # A batch has no second copy of a text that is in its row.
    inside = "text" in kept and documents.schema["text"].dataType == StringType()
    rows = documents.select(row, *([] if inside else [F.col("text").cast("string").alias("text")]))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(_predict(model), schema)
