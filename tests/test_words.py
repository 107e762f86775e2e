from __future__ import annotations

from collections import Counter

import pytest

from fairtally import average_word_length, word_counts
from fairtally.operators import words as words_module
from fairtally.operators.words import distinct_words, document_count

DOCS = ["la volpe è qui", "la  casa ", "", "   ", "qui\nqui", "la " * 50]


def tokens(text):
    if text == "":
        return [""]
    body = text.rstrip(" ")
    return body.split(" ") if body else []


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(t,) for t in DOCS], "value string").repartition(3)


@pytest.mark.parametrize("how", [{}, {"salt": 1}, {"salt": 5}, {"by_partition": True}])
def test_every_variant_gives_the_same_counts(docs, how):
    want = Counter(w for t in DOCS for w in tokens(t))
    assert dict(word_counts(docs, **how).collect()) == dict(want)


def test_numbers(docs):
    words = {w for t in DOCS for w in tokens(t)}
    assert document_count(docs).first()[0] == len(DOCS)
    assert distinct_words(docs).first()[0] == len(words)
    assert average_word_length(docs).first()[0] == pytest.approx(sum(map(len, words)) / len(words))


def test_bad_arguments(docs):
    with pytest.raises(ValueError):
        word_counts(docs, salt=0)
    with pytest.raises(ValueError):
        word_counts(docs, salt=2, by_partition=True)


def test_counts_per_partition_cost_one_shuffle(spark):
    docs = spark.createDataFrame([("a b a",), ("b",)], "value string")
    plan = word_counts(docs, by_partition=True)._jdf.queryExecution().sparkPlan().toString()
    executed = word_counts(docs, by_partition=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and executed.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("most", [3, 500_000])
def test_counts_per_partition(spark, monkeypatch, most):
    monkeypatch.setattr(words_module, "LOCAL_WORDS", most)
    parts = [["a b a", "c"], ["a", "b b b b "], []]
    df = spark.sparkContext.parallelize([[(t,) for t in p] for p in parts], 3).flatMap(lambda p: p).toDF("value string")
    local = words_module.partition_counts(df)
    assert "Exchange" not in local._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(tuple, local.collect()))
    if most > 3:
        assert rows == [("a", 1), ("a", 2), ("b", 1), ("b", 4), ("c", 1)]
    assert dict(word_counts(df, by_partition=True).collect()) == {"a": 3, "b": 5, "c": 1}
