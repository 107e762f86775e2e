import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairtally.llm import common, minhash
from frames import no_documents, odd_documents, words


def brute(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("size", [4, 5])
def test_equals_brute_force(spark, size):
    rng = random.Random(size)
    texts = []
    for _ in range(12):  # families of copies, near copies and less near ones
        base = words(rng, rng.randint(4, 150))
        for _ in range(rng.randint(1, 14)):
            copy = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(words(rng, 3))
            texts.append(" ".join(copy))
    passage = " ".join(words(rng, 40))
    texts += [passage + " " + " ".join(words(rng, 60)) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size).collect()}
    assert found == brute(rows, size)


def test_without_star_rounds_the_rest_finds_all(spark):
    rng = random.Random(9)
    base = words(rng, 120)
    rows = []
    for i in range(40):
        copy = base[:]
        for _ in range(i % 7):
            copy[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 4, star_rounds=0).collect()}
    assert found == brute(rows, 4)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = minhash.near_duplicates(docs, 4).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[2].component_id, by[3].component_id, by[1].kept) == (1, 1, True)
    assert (by[9].component_id, by[8].component_id) == (8, 8)
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (4, 5, 6))
    assert all(r.component_id is None and not r.kept for r in rows if r.doc_id is None)
    left = minhash.drop_duplicates(docs, 5)
    assert left.columns == docs.columns
    # The row without an id that says what document 1 says goes, the one without a text stays.
    assert sorted((r.doc_id or 0, r.text) for r in left.where("doc_id IS NULL").collect()) == [(0, None)]
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 4, 5, 6, 7, 8, 10, 11]


@pytest.mark.parametrize("rare", [1, 4, 16])
def test_loose_copies_make_few_pairs_and_lose_no_link(spark, monkeypatch, rare):
    """Many near copies of a text, and outliers that are like all of them but hardly linked."""
    monkeypatch.setattr(minhash, "RARE", rare)
    rng = random.Random(rare)
    base, texts = words(rng, 150, 10**6), []
    for i in range(420):
        copy = base[:]
        for _ in range(rng.choice([1, 2, 3]) if i % 7 else rng.choice([5, 6, 7])):
            copy[rng.randrange(150)] = f"w{rng.randrange(400)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    matched, made = minhash._Links.matched, []

    def counting(self, pairs):
        pairs = minhash.stored(pairs, "pairs")
        made.append(pairs.count())
        return matched(self, pairs)

    monkeypatch.setattr(minhash._Links, "matched", counting)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 4).collect()}
    assert found == brute(list(enumerate(texts)), 4)
    if rare == 16:
        assert made[-1] < 10 * len(texts)


def test_no_step_plans_many_exchanges_at_once(spark, monkeypatch):
    """The driver broadcasts and shuffles for a whole plan at a time, so its memory grows with the largest one."""
    rng = random.Random(5)
    base, texts = words(rng, 80), []
    for i in range(60):
        copy = base[:] if i % 2 else words(rng, 80)
        for _ in range(i % 5):
            copy[rng.randrange(80)] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    written, steps = common.stored, {}

    def counting(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        steps[label] = max(steps.get(label, 0), len(re.findall(r"(?:Broadcast)?Exchange ", plan)))
        return written(df, label)

    monkeypatch.setattr(minhash, "stored", counting)
    monkeypatch.setattr(common, "stored", counting)
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()}
    assert found == brute(rows, 4)
    assert max(steps.values()) <= 12, steps


def test_rows_without_ids_and_repeated_rows_leave_one(spark):
    rng = random.Random(4)
    a, b = (" ".join(words(rng, 60)) for _ in range(2))
    near = a.replace(a.split()[30], "changed", 1)
    rows = [(5, a, "x"), (5, a, "x"), (5, a, "y"), (9, near, "x"), (None, a, "x"), (None, b, "x"), (None, b, "x"), (None, b.upper(), "x"), (None, " ", "x"), (None, None, "x")]
    left = minhash.drop_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), 5).collect()
    assert [r.doc_id for r in left].count(5) == 1 and sum(r.text is not None and r.text.lower() == b for r in left) == 1
    assert len(left) == 4


def test_no_documents(spark):
    assert minhash.near_duplicates(no_documents(spark), 4).collect() == []
    only_empty = odd_documents(spark).where(F.col("doc_id").isin(4, 5, 6))
    assert minhash.near_duplicates(only_empty, 4).where("kept").count() == 3


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    a, b = (v[:, None] for v in minhash.multipliers(512))
    sign = lambda s: ((s >> np.uint64(32)).astype(np.uint32) * a + b).min(axis=1)
    share = (sign(minhash.mix(x[:1500])) == sign(minhash.mix(x[500:]))).mean()
    assert abs(share - 0.5) < 0.08
