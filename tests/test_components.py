import random

from textloom.operators.components import connected_components


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components_match_union_find(spark):
    r = random.Random(3)
    cases = [
        [(i, i + 1) for i in range(40)],
        [(r.randrange(60), r.randrange(60)) for _ in range(45)],
        [(5, 5), (None, 2), (1, 2), (2, 1), (1, 2)],
    ]
    for edges in cases:
        got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
        assert sorted(map(tuple, got.collect())) == sorted(brute(edges).items())


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
