"""Small tables with the cases that every operator must handle."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key string, component string, kept boolean"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) + str(rng.randrange(vocabulary)) for _ in range(n)]


def odd_documents(spark):
    """Null ids, texts and labels, empty and blank texts, repeated rows, a very long text, clashing column names."""
    rng = random.Random(3)
    long = " ".join(words(rng, 30_000))
    base = words(rng, 200)
    near = base[:]
    near[50] = "changed"
    rows = [
        (1, " ".join(base), "en", "src0"),
        (2, " ".join(near), "en", "src0"),
        (3, " ".join(base), None, "src1"),
        (3, " ".join(base), None, "src1"),
        (4, None, "en", "src1"),
        (5, "", "de", None),
        (6, " \t\n\x0b ", "de", "src2"),
        (7, long, "de", "src12"),
        (None, " ".join(base), "en", "src2"),
        (None, None, None, None),
        (8, "one two", "en", "src12"),
        (9, "One  TWO", "de", "src12"),
        (10, "12 34 !! ??", "de", "src3"),
        (11, "Ünïcode wörter und \U0001f600 mehr davon heute noch ein paar wörter für den text.", "de", "src3"),
    ]
    full = [(i, t, lang, s, len(t or ""), "x", "k", "c", False) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
