import random

import pyarrow as pa

from fairtally.llm import langid
from frames import no_documents, odd_documents

SYLLABLES = {"aa": ["tha", "ing", "the", "ore"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eau", "oux", "ché", "tré"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)) + "."


def test_held_out_accuracy_and_rejection(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(5, 80)), lang) for i, lang in enumerate(x for x in list(SYLLABLES) * 40 for _ in range(3))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs.where("doc_id % 3 <> 1"))
    assert len(model.languages) == 9
    odd = spark.createDataFrame([(9999, "ЖЖЩ ЫЪЭ ЯЮФ ЦХЪ " * 6, None)], docs.schema)
    found = {r.row.doc_id: r for r in langid.identify(docs.union(odd), model).collect()}
    held = [(found[i].lang_pred, lang) for i, _, lang in rows if i % 3 == 1]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert not any(found[i].rejected for i, _, _ in rows)
    assert found[9999].rejected and found[9999].lang_pred != langid.UNKNOWN
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = langid.fit(docs)
    assert set(model.languages) == {"en", "de"}
    rows = langid.identify(docs, model, keep_row=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == langid.UNKNOWN) == (not letters)
        assert r.rejected or letters
    same = [(r.lang_pred, r.score) for r in rows if r.row.doc_id == 3]
    assert same[0] == same[1]


def test_empty_table_and_no_labels(spark):
    model = langid.fit(no_documents(spark))
    assert model.languages == []
    assert {r.lang_pred for r in langid.identify(odd_documents(spark), model).collect()} == {langid.UNKNOWN}
    assert langid.identify(no_documents(spark), model).collect() == []


def test_batches_hold_a_text_once_and_few_texts_are_counted_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a short text {i}", "en") for i in range(600)], "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    found = langid.identify(docs, model, keep_row=True)
    assert found._jdf.queryExecution().optimizedPlan().child().output().size() == 1
    assert {r.row.doc_id for r in found.collect()} == set(range(600))
    number = langid.identify(docs.withColumn("text", docs.doc_id), model, keep_row=True).collect()
    assert len(number) == 600 and all(r.lang_pred == langid.UNKNOWN for r in number)
    counted, gram_counts = [], langid.gram_counts
    monkeypatch.setattr(langid, "gram_counts", lambda texts, dims: (counted.append(len(texts)), gram_counts(texts, dims))[1])
    rows = pa.array([{"doc_id": i, "text": f"text {i}"} for i in range(600)])
    parts = list(langid._predict(model)([pa.record_batch({"row": rows})]))
    assert [r["doc_id"] for p in parts for r in p.column("row").to_pylist()] == list(range(600))
    assert max(counted) <= 256 and sum(counted) == 600
