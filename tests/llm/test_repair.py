"""The search against all repairs, and whole conversations against a plain program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fairtally.llm import repair
from fairtally.llm.repair import ASSISTANT, DONE, STATES, START, Costs, Item, Search

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, part int"


def all_repairs(items, start, ends, costs=Costs()):
    """Least (cost, audit) by trying every edit of every row and up to two insertions at each place."""
    names = {START: "", 1: "s", 2: "u", 3: "a"}
    best = None
    options = [["D" * x.count] + ([] if x.must_go else ["K", "R"]) for x in items]
    for edits in itertools.product(*options):
        for inserts in itertools.product(range(3), repeat=len(items) + 1):
            state, cost, audit, ok = start, 0, "", True
            for k in range(len(items) + 1):
                for _ in range(inserts[k]):
                    state, cost, audit = repair.after_row(state), cost + costs.insert, audit + "I"
                if k == len(items):
                    break
                x, e = items[k], edits[k]
                audit += e
                if e[0] == "D":
                    cost += costs.delete * len(e)
                    continue
                after = repair.kept_state(x, state) if e == "K" else repair.after_row(state)
                if after is None:
                    ok = False
                    break
                cost += (costs.rerole if e == "R" else 0) + (costs.truncated if x.truncated else 0)
                state = after
            if ok and state in ends and (best is None or (cost, audit) < best):
                best = (cost, audit)
    assert names
    return best


def random_items(rng, n):
    return [Item(rng.choice("uuaasx"), rng.random() < 0.2, rng.random() < 0.25, 1) for _ in range(n)]


def test_search_against_all_repairs():
    rng = random.Random(1)
    for n in [0, 1, 2, 3, 4] * 12:
        items = random_items(rng, n)
        assert Search(items, START, DONE).run() == all_repairs(items, START, DONE)
    for n in [0, 1, 2, 3] * 4:
        items = random_items(rng, n)
        for start in STATES:
            for end in STATES:
                assert Search(items, start, (end,)).run() == all_repairs(items, start, (end,)), (items, start, end)


@pytest.mark.parametrize("costs", [Costs(1, 2, 1, 0), Costs(3, 4, 1, 2), Costs(2, 1, 3, 9)])
def test_other_costs(costs):
    rng = random.Random(costs.insert)
    for _ in range(25):
        items = random_items(rng, rng.randint(0, 4))
        assert Search(items, START, DONE, costs).run() == all_repairs(items, START, DONE, costs)


def test_search_is_not_exhaustive():
    rng = random.Random(2)
    search = Search(random_items(rng, 2000), START, DONE)
    search.run()
    assert search.expanded < 40 * 2000


def test_bounds_never_exceed_the_cost():
    rng = random.Random(3)
    for _ in range(30):
        items = random_items(rng, rng.randint(1, 5))
        for ends in (DONE, (START,), (1,), (2,), (ASSISTANT,)):
            bounds = repair.suffix_bounds(items, Costs(), ends)
            for i in range(len(items) + 1):
                for state in STATES:
                    found = Search(items[i:], state, ends).run()
                    assert found is None or bounds[i][state] <= found[0]


def test_chained_segments_equal_one_search():
    rng = random.Random(5)
    for _ in range(40):
        items = random_items(rng, rng.randint(2, 14))
        cuts = sorted(rng.sample(range(1, len(items)), min(len(items) - 1, rng.randint(1, 3))))
        parts = [items[a:b] for a, b in zip([0, *cuts], [*cuts, len(items)])]
        ways = [
            [{"start": s, "end": e, "cost": r[0], "audit": r[1]} for s in STATES for e in STATES if (r := Search(p, s, (e,)).run())]
            for p in parts
        ]
        cost, steps = repair.chain(ways)
        assert (cost, "".join(a for _, a in steps)) == Search(items, START, DONE).run()


def plain(rows):
    """The contract row by row, with a search over dictionaries of states."""
    out = []
    blank = lambda v: " " if v is None else str(v)
    for conv in {r[0] for r in rows}:
        bad = []
        for _, turn, role, text in [r[:4] for r in rows if r[0] == conv]:
            v = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
            role, text = blank(role), blank(text)
            if v == 0:
                continue
            text = "" if v == 1 else re.sub("[.!?]", "", text) if v == 2 else text
            role = "user" if v == 4 else role
            bad += [(turn, role, text)] * (2 if v == 3 else 1)
        bad.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}:{r[2]}".encode()).hexdigest()))
        turns = [t for t, _, _ in bad if t is not None]
        n = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
        n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(bad, bad[1:]))
        seen, ways = set(), {"": (0, "", ())}
        for _, role, text in bad:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            step = {s: (c + 2, a + "D", t) for s, (c, a, t) in ways.items()}
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                for s, (c, a, t) in ways.items():
                    expected = "assistant" if s == "u" else "user"
                    after = [(expected[0], c + 1 + extra, a + "R", (*t, f"{expected}:{text}"))]
                    if role[:1] == expected[0] or (role[:1] == "s" and s == ""):
                        after.append((role[:1], c + extra, a + "K", (*t, f"{role}:{text}")))
                    for s2, *way in after:
                        step[s2] = min(step.get(s2, (10**9, "", ())), tuple(way))
            ways = step
        cost, audit, lines = min(ways[s] for s in ("", "a") if s in ways)
        out.append((conv, *n.values(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng, n, most):
    rows = []
    for conv in [*range(n), None]:
        role = rng.choice(["user", "system", "assistant"])
        for turn in range(rng.randint(1, most)):
            text = rng.choice(["Fine.", "Why?", "So it", "Good!  \n", " \t", "", None, f"Answer {rng.randrange(40)}."])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role if rng.random() < 0.9 else rng.choice([None, "", "tool", "system"]), text, "x", 7))
            role = "assistant" if role == "user" else "user"
    return rows


def collected(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


@pytest.mark.parametrize("rows_each", [1000, 3])
def test_conversations(spark, monkeypatch, rows_each):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", rows_each)
    rows = conversations(random.Random(11), 60, 12)
    rows += rows[:40]  # repeated rows
    rows += [(7, None, "user", "the same", "x", 1)] * 500
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.repair_conversations(repair.damaged(df), present=F.col("present"))
        assert collected(found) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_long_conversation_fills_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 50)
    rows = [r for r in conversations(random.Random(3), 1, 700) if r[0] == 0]
    rows = [(5, t, *rest) for _, t, *rest in rows for _ in range(2)]
    assert collected(repair.repair_conversations(repair.damaged(spark.createDataFrame(rows, SCHEMA)), present=F.col("present"))) == plain(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = repair.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.", "x", 1)], SCHEMA))
    assert collected(repair.repair_conversations(df, present=F.col("present"))) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(empty).collect() == []


def test_undamaged_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 0, "user", "One?")]
    found = collected(repair.repair_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
    assert [(r[0], r[6], r[7]) for r in found] == [(1, 0, "KKK"), (2, 2, "D")]
