import numpy as np
import pytest

from fairtally.llm import flatgraph

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep bigint, grp string"


def brute(rows, least):
    able = {}
    for i, v, label in rows:
        good = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        able[i] = (np.array(v, np.float32).astype(float), label) if good else None
    links, root = {i: 0 for i in able}, {i: i for i in able}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(able)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if able[a] and able[b] and able[a][1] == able[b][1] and len(able[a][0]) == len(able[b][0]):
                x, y = able[a][0], able[b][0]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in able}


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 0, "g") for r in rows], SCHEMA)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in flatgraph.near_vectors(df, **more).collect()}


@pytest.mark.parametrize("most", [60, 2000])
def test_equals_brute_force(spark, most):
    rng = np.random.default_rng(most)
    rows = []
    for label in range(2):
        centers = rng.normal(size=(25, 16))
        for _ in range(160):
            c = centers[rng.integers(25)]
            v = c if rng.random() < 0.2 else c + rng.normal(size=16) * rng.choice([0.05, 0.15, 0.4])
            rows.append((len(rows), v.astype(np.float32).tolist(), label))
    found, want = run(spark, rows, most=most), brute(rows, 0.93)
    links = sum(v[0] for v in want.values())
    assert sum(v[0] for v in found.values()) >= 0.98 * links
    assert all(found[i][0] <= want[i][0] for i in want)
    assert sum(found[i] == want[i] for i in want) >= 0.97 * len(want)


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (5, one, 1),
        (2, one, 1),
        (3, [2.0, 0.0, 0.0], 1),
        (4, one, 2),
        (6, one, None),
        (7, None, 1),
        (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 0.0], 1),
        (10, [1.0, float("nan"), 0.0], 1),
        (11, [float("inf"), 0.0, 0.0], 1),
        (12, [], 1),
        (13, [1.0, 0.0], 1),
    ]
    found = run(spark, rows)
    assert found == brute(rows, 0.93)
    assert found[5] == (2, 2, False)


def test_null_and_repeated_ids(spark):
    one = [1.0, 0.0]
    df = spark.createDataFrame([(1, one, 1), (1, one, 1), (None, one, 1), (2, one, 1)], "vec_id bigint, embedding array<float>, label int")
    rows = sorted(map(tuple, flatgraph.near_vectors(df).collect()), key=repr)
    assert rows == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False)]


def test_no_vectors(spark):
    assert run(spark, []) == {}


def test_audit_counts_what_is_missed(spark):
    one = [[1.0, 0.01 * i] for i in range(6)]
    nodes = spark.createDataFrame([(i, v, 1, "1|2") for i, v in enumerate(one)], "rep bigint, v array<double>, weight bigint, grp string")
    width = flatgraph.WIDTHS[0]
    index = flatgraph._indexed(nodes, width, 100)
    assert flatgraph.audit(index, nodes, width, 0.93) == 1.0
    assert flatgraph.audit(index.where("rep < 3"), nodes, width, 0.93) < 0.5


def test_links_of_a_dense_group_reach_beyond_the_shard(spark):
    rng = np.random.default_rng(3)
    center = rng.normal(size=16)
    rows = [(i, (center + rng.normal(size=16) * 0.1).tolist(), 1) for i in range(300)]
    rows += [(300 + i, rng.normal(size=16).tolist(), 1) for i in range(100)]
    found, want = run(spark, rows, most=60), brute(rows, 0.93)
    assert max(n for n, _, _ in want.values()) > 250
    assert sum(v[0] for v in found.values()) >= 0.98 * sum(v[0] for v in want.values())
    assert all(found[i][0] <= want[i][0] for i in want)


def test_vectors_that_no_center_tells_apart_are_dealt_into_blocks(spark):
    rng = np.random.default_rng(4)
    one = rng.normal(size=8)
    rows = [(i, (one * (1 + i / 7)).astype(np.float32).tolist(), 1) for i in range(200)]
    rows += [(200 + i, rng.normal(size=8).astype(np.float32).tolist(), 1) for i in range(100)]
    assert run(spark, rows, most=40) == brute(rows, 0.93)
    nodes = spark.createDataFrame([(i, v, 1, "1|8") for i, v, _ in rows], "rep bigint, v array<double>, weight bigint, grp string")
    shards = flatgraph.overlapping_shards(nodes, flatgraph.WIDTHS[0], 40)
    assert shards.where("home").count() == 300
    assert max(r["count"] for r in shards.groupBy("grp").count().collect()) <= 60


def test_vectors_that_differ_in_length_only_are_one_node(spark, monkeypatch):
    sizes, indexed = [], flatgraph._indexed
    monkeypatch.setattr(flatgraph, "_indexed", lambda nodes, *more: sizes.append(nodes.count()) or indexed(nodes, *more))
    rows = [(i, [3.0 * i, 1.0 * i, -7.0 * i], 1) for i in range(1, 30)]
    assert run(spark, rows) == brute(rows, 0.93)
    assert sizes == [1]


def test_counts_exactly_where_the_widest_index_misses_too_much(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "audit", lambda *_: 0.5)
    rng = np.random.default_rng(5)
    center = rng.normal(size=8)
    rows = [(i, (center + rng.normal(size=8) * 0.2).tolist(), 1) for i in range(120)]
    with pytest.warns(UserWarning, match="recall 0.500"):
        assert run(spark, rows, most=40) == brute(rows, 0.93)
