"""The manifest against a plain recursive tree over the sorted rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fairtally.llm import merkle
from fairtally.llm.common import ascii_lower, remainder
from fairtally.llm.oracles import _CRC_TABLE, _crc32
from frames import no_documents, odd_documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(framed, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climbed(nodes):
    """The top of a tree, and for each leaf its steps (before, behind)."""
    steps, place, now = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(now) > 1:
        for i, at in enumerate(place):
            run = now[at // 16 * 16 : at // 16 * 16 + 16]
            steps[i].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
            place[i] = at // 16
        now = [h(*now[k : k + 16]) for k in range(0, len(now), 16)]
    return now[0], steps


def brute(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    out, tops = [], []
    for s in sources:
        own = sorted(
            ((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), i) for i, r in enumerate(rows) if r["source"] == s)
        )
        top, steps = climbed([x[2] for x in own])
        tops.append(top)
        out.append((own, top, steps))
    root, top_steps = climbed(tops)
    found = []
    for (own, top, steps), rest in zip(out, top_steps):
        for (_, _, digest, i), path in zip(own, steps):
            r = rows[i]
            key = "" if r["doc_id"] is None else str(r["doc_id"])
            now = digest
            if zlib.crc32(key.encode()) % 5 == 0:
                now = leaf(r, None if r["text"] is None else r["text"].translate({c: c + 32 for c in range(65, 91)}))
            for before, behind in path + rest:
                now = h(before, now, behind)
            proof = h(*[a + b for a, b in path + rest])
            found.append((r["doc_id"], digest, top, root, proof, now, now == root))
    return sorted(found, key=repr)


def run(df, fanout=16):
    low = merkle.leaf_digest({c: F.col(c) for c in merkle.COLUMNS} | {"text": ascii_lower(F.col("text"))})
    made = merkle.build_manifest(df, fanout=fanout, carry={"tampered": F.when(remainder("doc_id", 5) == 0, low)})
    found = merkle.proofs(made)
    folded = merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("path"))
    out = found.select("key", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"), folded.alias("f"))
    return made, sorted((tuple(r) for r in out.withColumn("v", F.col("f") == F.col("root")).collect()), key=repr)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    made, found = run(docs)
    want = brute([r.asDict() for r in docs.collect()])
    assert found == want and made.root == want[0][3]


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17, 1], [300], [4, 1, 257, 33], [1] * 20 + [40]])
def test_tree_shapes(spark, sizes):
    rng = random.Random(len(sizes))
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i, rng.choice(["Ab c", "x", None, "ÄÖ"]), "en", f"s{s:02d}", rng.choice([None, 3])))
            i += rng.randint(0, 2)  # some doc_ids repeat
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    assert run(df)[1] == brute([r.asDict() for r in df.collect()])


def test_empty_table_has_no_root(spark):
    made, found = run(no_documents(spark))
    assert made.root is None and found == []


def test_order_of_reading_does_not_matter(spark):
    docs = odd_documents(spark)
    a = merkle.build_manifest(docs.orderBy(F.desc("text"))).root
    assert a == merkle.build_manifest(docs.repartition(7, "lang")).root == merkle.build_manifest(docs).root


def test_a_changed_row_changes_the_root(spark):
    rows = [(i, f"text {i}", "en", "s", 1) for i in range(40)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    roots = {merkle.build_manifest(spark.createDataFrame(rows[:k] + [(k, "x", "en", "s", 1)] + rows[k + 1 :], schema)).root for k in (0, 17, 39)}
    assert len(roots | {merkle.build_manifest(spark.createDataFrame(rows, schema)).root}) == 4


def test_no_python_and_no_text_in_shuffles(spark):
    df = merkle.proofs(merkle.build_manifest(odd_documents(spark)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text", ["", "1", "abc", "12345:7", " :3"])
def test_crc_of_the_sql(text):
    import duckdb

    sql = f"WITH {_CRC_TABLE}, d AS (SELECT '{text}' AS x) SELECT {_crc32('x')} FROM d, crc"
    assert duckdb.connect().execute(sql).fetchone()[0] == zlib.crc32(text.encode())
