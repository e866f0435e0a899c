"""Components against a plain union of sets."""

import random

import pytest

from tollgate.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def rising(n):
    return [(i, i + 1) for i in range(n)]


@pytest.mark.parametrize("edges", [rising(70), [(b, a) for a, b in rising(70)], [(i, 99) for i in range(40)], [(0, i) for i in range(1, 40)],
                                   [(i, i + 1 + 2 * (i % 2)) for i in range(60)], [(5, 5), (5, 5), (7, 6)], "random"])
def test_components(spark, edges):
    if edges == "random":
        rng = random.Random(3)
        edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == plain(edges) and len(got) == len(plain(edges))


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
