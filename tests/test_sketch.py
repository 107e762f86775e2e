from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fairtally import HashFamily, build_sketch, item_frequencies, merge_frequencies, merge_sketches, parse_items, sketch_report, top_k_with_ties, topk_error
from fairtally.operators import sketch as module
from helpers import estimates, sketch_tables

H3 = HashFamily(width=16, a=(17, 101, 2003), b=(5, 42, 1234), sign_a=(3, 7, 11), sign_b=(1, 0, 5))


def frame(spark, items):
    return spark.createDataFrame([(int(x),) for x in items], "item bigint")


def stream(n=500, distinct=60, seed=1):
    rng = random.Random(seed)
    # One item holds a third of the stream.
    return [7 if rng.random() < 1 / 3 else rng.randrange(distinct) for _ in range(n)]


def cells(sketch):
    return {(r.r, r.c): (r.cm, r.cs) for r in sketch.cells.collect()}


def brute(items, h):
    cm, cs = sketch_tables(items, h)
    return {key: (cm[key], cs[key]) for key in cm}


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5])
def test_cells_and_estimates_equal_brute_force(spark, depth):
    h = HashFamily.seeded(depth, 8, seed=depth)
    items = stream(seed=depth)
    df = frame(spark, items).repartition(3)
    freq = item_frequencies(df)
    raw, counted = build_sketch(df, h), build_sketch(freq, h, weight="cnt")
    want = brute(items, h)
    assert cells(raw) == cells(counted) == want
    tables = sketch_tables(items, h)
    got = {r.item: (r.cm_est, r.cs_est) for r in module.with_estimates(freq, counted).collect()}
    assert got == {x: estimates(x, tables, h) for x in set(items)}


def test_estimates_of_items_that_never_came(spark):
    sketch = build_sketch(frame(spark, [1]), HashFamily.seeded(3, 1000, seed=1))
    row = module.with_estimates(frame(spark, [2]), sketch).first()
    assert (row.cm_est, row.cs_est) == (0, 0)


def test_repeated_rows_and_other_columns_come_back(spark):
    items = stream()
    rows = frame(spark, [items[0], items[0], items[1]]).withColumn("c", F.lit("x")).withColumn("sign", F.lit(None).cast("int"))
    sketch = build_sketch(frame(spark, items), H3)
    found = module.with_estimates(rows, sketch)
    assert found.columns == ["item", "c", "sign", "cm_est", "cs_est"]
    tables = sketch_tables(items, H3)
    want = sorted(estimates(x, tables, H3) for x in (items[0], items[0], items[1]))
    assert sorted((r.cm_est, r.cs_est) for r in found.collect()) == want


def test_estimates_read_the_items_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    items = frame(spark, stream()).mapInArrow(count, "item bigint")
    n = len(stream())
    for estimate in (module.estimate_cm, module.estimate_cs):
        seen.value = 0
        freq = item_frequencies(items)
        estimate(freq, build_sketch(freq, H3, weight="cnt")).collect()
        assert seen.value == n


def test_negative_and_huge_items(spark):
    items = [-1, -8122, 2**62, -(2**63), 2**63 - 1]
    assert cells(build_sketch(frame(spark, items), H3)) == brute(items, H3)
    big = HashFamily.seeded(3, 50, seed=2, p=2**31 - 1)
    assert cells(build_sketch(frame(spark, items), big)) == brute(items, big)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=40),
    st.lists(st.integers(0, 9), min_size=1, max_size=40),
)
def test_merge_equals_whole_and_cm_never_undercounts(spark, left, right):
    merged = merge_sketches(build_sketch(frame(spark, left), H3), build_sketch(frame(spark, right), H3))
    assert cells(merged) == brute(left + right, H3)
    freq = item_frequencies(frame(spark, left + right))
    assert module.with_estimates(freq, merged).where("cm_est < cnt").isEmpty()


def test_merge_needs_equal_hashes(spark):
    one = build_sketch(frame(spark, [1]), H3)
    for other in (HashFamily.seeded(3, 16, seed=1), HashFamily(8, H3.a, H3.b, H3.sign_a, H3.sign_b)):
        with pytest.raises(ValueError):
            one.merge(build_sketch(frame(spark, [1]), other))


@pytest.mark.parametrize(
    "change",
    [{"width": 0}, {"a": (0, 1, 1)}, {"a": (1,)}, {"b": (-1, 0, 0)}, {"sign_a": (8121, 1, 1)}, {"p": 2**31}, {"a": ()}],
)
def test_bad_hash_families(change):
    values = {"width": 4, "a": (1, 2, 3), "b": (0, 0, 0), "sign_a": (1, 2, 3), "sign_b": (0, 0, 0), "p": 8121}
    with pytest.raises(ValueError):
        HashFamily(**{**values, **change})


def test_seeded_families_repeat():
    assert HashFamily.seeded(4, 10, seed=3) == HashFamily.seeded(4, 10, seed=3) != HashFamily.seeded(4, 10, seed=4)


def test_frequencies_merge_doubles_equal_batches(spark):
    freq = item_frequencies(frame(spark, [1, 1, 2]))
    assert dict(merge_frequencies(freq, freq).collect()) == {1: 4, 2: 2}


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 50])
def test_top_k_keeps_ties(spark, k):
    items = [1] * 5 + [2] * 4 + [3] * 4 + [4] * 2 + [5]
    ranked = sorted(Counter(items).values(), reverse=True)
    floor = ranked[min(k, len(ranked)) - 1]
    got = dict(top_k_with_ties(item_frequencies(frame(spark, items)), k).collect())
    assert got == {x: n for x, n in Counter(items).items() if n >= floor}
    with pytest.raises(ValueError):
        top_k_with_ties(item_frequencies(frame(spark, items)), 0)


def test_report_and_error(spark):
    items = stream(n=800)
    freq = item_frequencies(frame(spark, items))
    sketch = build_sketch(freq, H3, weight="cnt")
    row = sketch_report(freq, sketch, 3).first()
    counts = Counter(items)
    floor = sorted(counts.values(), reverse=True)[2]
    top = [x for x in counts if counts[x] >= floor]
    tables = sketch_tables(items, H3)
    errors = [[abs(counts[x] - e) / counts[x] for e in estimates(x, tables, H3)] for x in top]
    want = [sum(col) / len(top) for col in zip(*errors)]
    assert (row.n, row.n_distinct, row.n_topk) == (800, len(counts), len(top))
    assert [row.err_cm, row.err_cs] == pytest.approx(want)
    assert list(topk_error(freq, sketch, 3).first()) == pytest.approx(want)


def test_report_reads_the_items_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    freq = item_frequencies(frame(spark, stream()).mapInArrow(count, "item bigint"))
    sketch_report(freq, build_sketch(freq, H3, weight="cnt"), 3).collect()
    assert seen.value == len(stream())


def test_items_are_whole_numbers(spark):
    lines = spark.createDataFrame([("12",), ("-3",), ("+4",)], "value string")
    assert [r.item for r in parse_items(lines).collect()] == [12, -3, 4]
    for bad in ("", " 5", "5 ", "1.5", "abc", "9223372036854775808", None):
        with pytest.raises(Exception, match="not an integer"):
            parse_items(spark.createDataFrame([(bad,)], "value string")).collect()
    with pytest.raises(Exception, match="missing item"):
        item_frequencies(spark.createDataFrame([(None,)], "item bigint")).collect()
