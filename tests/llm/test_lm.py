import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairtally.llm import lm
from fairtally.llm.common import remainder
from frames import no_documents, odd_documents


def brute(rows, order, prior, held):
    docs = [(i, held(i), (t or "").encode().lower().split() + [None]) for i, t in rows]
    count = [Counter() for _ in range(order + 1)]
    grams = lambda w, i, n: tuple(([0] + w)[i - n + 2 : i + 2]) if n > 1 else (w[i],)
    texts = 0
    for _, out, w in docs:
        if not out:
            texts += 1
            for i in range(len(w)):
                for n in range(1, order + 1):
                    if i - n + 2 >= 0:
                        count[n][grams(w, i, n)] += 1
    total, distinct = sum(count[1].values()), len(count[1])
    found = []
    for i, out, w in docs:
        base = score = 0.0
        for j, x in enumerate(w):
            p = (count[1][(x,)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for n in range(2, order + 1):
                if j - n + 2 >= 0:
                    before = grams(w, j, n)[:-1]
                    context = texts if before == (0,) else count[n - 1][before]
                    p = (count[n][grams(w, j, n)] + prior * p) / (context + prior)
            score += math.log10(p)
        found.append((i, out, len(w), sum(count[1][(x,)] > 0 for x in w), total, base, score))
    return found


def rounded(rows):
    return sorted(((str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6)) for r in rows), key=repr)


@pytest.mark.parametrize(("order", "chunk"), [(1, 10**6), (2, 50), (3, 200)])
def test_equals_brute_force(spark, order, chunk):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("abcdeFG") * rng.randint(1, 2) for _ in range(rng.randint(0, 30)))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3, "doc_id")
    found = lm.score_documents(docs, remainder("doc_id", 7) == 2, order, 7.0, chunk).collect()
    assert rounded(found) == rounded(brute(rows, order, 7.0, lambda i: zlib.crc32(str(i).encode()) % 7 == 2))


def test_probabilities_of_all_next_words_add_up(spark):
    words = ["a", "b", "c", "d"]
    train = [(0, "a b a c d d a b"), (1, "b a"), (2, "c")]
    ask = [(100 + i, f"a b {w}") for i, w in enumerate([*words, "never"])] + [(200, "a b")]
    docs = spark.createDataFrame(train + ask, "doc_id bigint, text string")
    score = {r.doc_id: r.score for r in lm.score_documents(docs, F.col("doc_id") >= 100, 2, 3.0).collect()}
    ends = {r.doc_id: r.score for r in lm.score_documents(
        spark.createDataFrame(train + [(100 + i, f"{w}") for i, w in enumerate([*words, "never"])] + [(200, "")], docs.schema), F.col("doc_id") >= 100, 2, 3.0).collect()}
    # From the start of a text: every word and the end, each without what follows it.
    counts = Counter({"a": 1, "b": 1, "c": 1})
    n, v = 14, 5
    unigram = Counter("a b a c d d a b b a c".split())
    first = [math.log10((counts[w] + 3 * (unigram[w] + 1) / (n + v + 1)) / 6) for w in words]
    assert sum(10**x for x in first) + 3 * (1 / (n + v + 1)) / 6 + 10 ** ends[200] == pytest.approx(1)
    assert score[200] < 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = lm.score_documents(docs, remainder("doc_id", 7) == 2).collect()
    assert len(rows) == docs.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (4, 5, 6))
    same = [r for r in rows if r.doc_id == 3]
    assert same[0] == same[1]
    assert lm.score_documents(no_documents(spark), remainder("doc_id", 7) == 2).collect() == []


def test_no_training_text(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    row = lm.score_documents(docs, docs.doc_id > 0).first()
    assert (row.n_known, row.train_tokens, row.score, row.base_score) == (0, 0, 0.0, 0.0)


def walked(w, order, prior, known, total, texts):
    """A walk over an explicit automaton: states are tuples of words, None is the end, 0 the start."""
    count = lambda g: texts if g == (0,) else known[g]
    distinct = sum(1 for g in known if len(g) == 1)

    def arc(state, x):
        if not state:
            return (known[(x,)] + 1) / (total + distinct + 1)
        return (known[(*state, x)] + prior * arc(state[1:], x)) / (count(state) + prior)

    state, score, passed = (0,) if texts and order > 1 else (), 0.0, []
    for x in w:
        while state and not known[(*state, x)]:
            score += math.log10(prior / (count(state) + prior))
            state = state[1:]
        score += math.log10(arc(state, x))
        state = (*state, x)[-(order - 1) :] if order > 1 and known[(*state, x)] else ()
        passed.append(len(state))
    return score, passed


@pytest.mark.parametrize(("order", "segment"), [(1, 5), (2, 1), (3, 4), (4, 7), (3, 1000)])
def test_walk_carries_the_state_of_an_explicit_automaton(order, segment):
    rng = random.Random(order * segment)
    texts = [[rng.choice("abcde") for _ in range(rng.randint(0, 40))] for _ in range(20)]
    held = [i % 4 == 0 for i in range(20)]
    texts[0][:0] = ["never", "a"]
    known = Counter()
    for w, out in zip(texts, held):
        if not out:
            w = [0, *w, None]
            for n in range(1, order + 1):
                known.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if w[i : i + n] != [0])
    names = {x: i for i, x in enumerate(["a", "b", "c", "d", "e", "never"], 5)} | {None: lm.END}
    hashes = np.array([names[x] for w in texts for x in [*w, None]], np.uint64)
    sizes = np.array([len(w) + 1 for w in texts])
    chunk = lm.Chunk(0, list(range(20)), held, sizes, hashes)
    train, levels = np.repeat(~np.array(held), sizes), []
    for key, valid in chunk.grams(order):
        _, at = np.unique(key[valid], return_inverse=True)
        gram = np.full(len(key), -1)
        gram[valid] = at
        levels.append((gram, np.bincount(at, weights=train[valid]).astype(np.int64)))
    total, distinct = sum(n for g, n in known.items() if len(g) == 1), sum(len(g) == 1 for g in known)
    _, word = np.unique(hashes, return_inverse=True)
    automaton = lm.build_automaton(chunk, word, levels, total, distinct, 2.5)
    want = [walked([*w, None], order, 2.5, known, total, 15)[0] for w in texts]
    assert automaton.walk(word, sizes, segment).tolist() == pytest.approx(want)
    assert (np.diff(automaton.arcs[:-1]) > 0).all()
    contexts = {g for g in known if len(g) < order and g[-1] is not None}
    assert len(automaton.failure) == 1 + len(contexts) + (order > 1)


def test_texts_of_one_token(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (8, "")], "doc_id bigint, text string")
    rows = lm.score_documents(docs, docs.doc_id == 8, 4).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(1, 1, 2)] * 3
    assert len({r.score for r in rows}) == 1


def test_tasks_hold_few_bytes_per_token(monkeypatch):
    monkeypatch.setattr(lm.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    rng, n = np.random.default_rng(3), 400_000
    texts = [" ".join(f"w{x}" for x in part) for part in np.array_split((rng.pareto(0.8, n) * 50).astype(np.int64) % 90_000, 700)]
    docs = pa.record_batch({"doc_id": pa.array(range(700)), "held_out": pa.array([i % 7 == 2 for i in range(700)]), "text": pa.array(texts)})

    def peak(step):
        tracemalloc.start()
        try:
            found = step()
            return found, tracemalloc.get_traced_memory()[1] / n
        finally:
            tracemalloc.stop()

    asked, in_ask = peak(lambda: pa.Table.from_batches(lm._ask(3, 2, 10**7)([docs])))
    bucket = asked.column("bucket").to_numpy()
    answers = [peak(lambda: lm._answer(asked.filter(pa.array(bucket == b)))) for b in range(2)]
    answered = pa.concat_tables([a for a, _ in answers])
    content = pa.Table.from_batches(lm._content(10**7)([docs]))
    tokens, words = (sum(answered.column(c).to_pylist()) for c in ("tokens", "words"))
    scored, in_score = peak(lambda: lm._score(3, tokens, words, lm.PRIOR)(content, answered.select(["chunk", "level", "bucket", "counts"])))
    assert sum(scored.column("n_tokens").to_pylist()) == n + 700
    assert in_ask < 110 and in_score < 120, (in_ask, in_score, [p for _, p in answers])
