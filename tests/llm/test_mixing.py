import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fairtally.llm import mixing
from frames import no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shortage_goes_to_siblings_before_ancestors():
    tree = mixing.Tree((), {("a",): 1.0, ("b",): 1.0, ("a", "x"): 1.0, ("a", "y"): 1.0})
    supply = {("a", "x", "1"): 10, ("a", "y", "1"): 500, ("b", "x", "1"): 500}
    found = mixing.leaf_budgets(supply, tree, 400, 1)
    assert found == {("a", "x", "1"): 10, ("a", "y", "1"): 190, ("b", "x", "1"): 200}
    supply[("a", "y", "1")] = 50  # now the whole branch is short
    assert mixing.leaf_budgets(supply, tree, 400, 1) == {("a", "x", "1"): 10, ("a", "y", "1"): 50, ("b", "x", "1"): 340}
    assert sum(mixing.leaf_budgets(supply, tree, 10**6, 2).values()) == 2 * 560


def test_zero_weights_and_bad_weights():
    tree = mixing.Tree((), {("a",): 0.0})
    assert mixing.leaf_budgets({("a", "x", "1"): 10, ("b", "x", "1"): 10}, tree, 100, 1) == {("a", "x", "1"): 0, ("b", "x", "1"): 10}
    with pytest.raises(ValueError, match="weight"):
        mixing.leaf_budgets({("a", "x", "1"): 10}, mixing.Tree((), {("a",): -1.0}), 10, 1)
    assert mixing.leaf_budgets({}, tree, 100, 1) == {}


def brute(rows, tree, budget, most, seed):
    leaves = defaultdict(list)
    for r in rows:
        domain = "web" if r.source in mixing.WEB_SOURCES else "curated"
        leaves[(domain, r.lang, r.source)].append((r.doc_id, len(WORD.findall(r.text or ""))))
    supply = {k: sum(n for _, n in v) for k, v in leaves.items()}
    shares = mixing.leaf_budgets(supply, tree, sum(supply.values()) if budget is None else budget, most)
    chosen = []
    for leaf, own in leaves.items():
        full, rest = divmod(shares[leaf], supply[leaf]) if supply[leaf] else (0, 0)
        key = lambda d: hashlib.md5(f"{seed}|{full}|{'' if d[0] is None else d[0]}".encode()).hexdigest()
        total, extra, keys = 0, set(), defaultdict(int)
        for d in own:
            keys[key(d)] += d[1]
        for k in sorted(keys):
            total += keys[k]
            if total > rest:
                break
            extra.add(k)
        for d in own:
            epochs = full + (rest > 0 and key(d) in extra)
            if epochs:
                chosen.append((str(d[0]), leaf[0], str(leaf[1]), str(leaf[2]), d[1], epochs))
    return sorted(chosen)


@pytest.mark.parametrize("budget", [None, 500, 10**7, 0])
def test_equals_brute_force(spark, budget):
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 60))), rng.choice(["en", "de", None]), f"src{rng.randint(8, 11)}") for i in range(400)]
    rows += [(400 + i, "hot words " * 9, "en", "src0") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    tree = mixing.default_tree(docs)
    found = mixing.select_mixture(docs, tree, budget)
    got = sorted((str(r.row.doc_id), r.domain, str(r.language), str(r.source), r.n_tokens, r.epochs) for r in found.collect())
    assert got == brute(docs.collect(), tree, budget, mixing.MAX_EPOCHS, mixing.SEED)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = mixing.select_mixture(docs, mixing.default_tree(docs))
    got = sorted((str(r.row.doc_id), r.domain, str(r.language), str(r.source), r.n_tokens, r.epochs) for r in found.collect())
    assert got == brute(docs.collect(), mixing.default_tree(docs), None, mixing.MAX_EPOCHS, mixing.SEED)
    each = mixing.mixed_documents(docs, mixing.default_tree(docs))
    assert each.columns == docs.columns
    assert each.count() == found.agg(F.sum("epochs")).first()[0]
    assert mixing.mixed_documents(no_documents(spark), mixing.default_tree(no_documents(spark))).collect() == []
