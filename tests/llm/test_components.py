import random

from fairtally.llm.common import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_chains_stars_and_random_edges(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)]
    edges += [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(7, 7), (None, 3), (4, None), (500, 501)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert sorted(map(tuple, found.collect())) == sorted(brute(edges).items())


def test_without_edges(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a bigint, b bigint")) is None
