import random
import re
from collections import Counter

import pytest

from fairtally.llm import quality
from frames import no_documents, odd_documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def stats(df):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [(r.row.text, tuple(r[n] for n in names)) for r in quality.text_stats(df).collect()]


def test_statistics_equal_brute_force(spark):
    rng = random.Random(5)
    for text, found in stats(odd_documents(spark)):
        assert found == brute(text)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += ["x y z u v " * 5000, "a\n\na\n b\na|#", "  \x1c x", "a b c d e a b c d e f a b c d e", "! !"]
    for text, found in stats(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")):
        assert found == brute(text), text[:80]


def test_junk_of_one_kind_is_told_from_good_text(spark):
    rng = random.Random(6)
    good = [(i, ". ".join(" ".join(words(rng, 12)) for _ in range(6)) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words(rng, 80))) for i in range(25)]
    shouts = [(2000 + i, " ".join(w.upper() + "!!" for w in words(rng, 80))) for i in range(15)]
    docs = spark.createDataFrame(good + junk + shouts, "doc_id bigint, text string")
    kept = {r.row.doc_id for r in quality.judge_quality(docs).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    rows = quality.judge_quality(docs, keep_row=True)
    assert rows.count() == docs.count()
    assert rows.select("row.*").columns == docs.columns
    assert all(r.base_failed and not r.kept for r in rows.collect() if not (r.row.text or "").strip())
    assert quality.judge_quality(no_documents(spark)).collect() == []


def test_em_is_deterministic_and_bounded(spark):
    votes = spark.createDataFrame([(-1, 0)] * 5 + [(0, 1)] * 95, "a tinyint, b tinyint")
    one, two = (quality.fit_label_model(votes, ["a", "b"]) for _ in range(2))
    assert one == two and 0 < one.prior < 1
    assert all(sum(r) == pytest.approx(1) for r in one.on_good + one.on_bad)


def test_no_python_in_the_plan(spark):
    plan = quality.text_stats(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
