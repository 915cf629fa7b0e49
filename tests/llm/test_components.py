import random

from sparkwarden.llm.components import connected_components


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
    return sorted((x, find(x)) for x in root)


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    edges += [(7, 7), (None, 3), (4, None), (100, 101), (101, 100)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3))
    assert sorted(tuple(r) for r in got.collect()) == brute(edges)


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
