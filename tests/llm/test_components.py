"""Connected components against a plain search, on chains, hubs, repeats, loops and nulls."""

import random

import pytest

from peerscope.llm.components import connected_components


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


rng = random.Random(3)
CASES = {
    "none": [],
    "chain": [(i, i + 1) for i in range(300)],
    "shuffled chain": [(a * 7919 % 1009, (a + 1) * 7919 % 1009) for a in range(200)],
    "hubs": [(0, i) for i in range(1, 200)] + [(500, i) for i in range(300, 500)] + [(199, 300)],
    "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)],
    "loops, repeats, nulls": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (4, None), (3, 9)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    df = spark.createDataFrame(CASES[name], "a long, b long").repartition(3)
    got = connected_components(df).collect()
    assert {r.node: r.root for r in got} == brute(CASES[name]) and len(got) == len({r.node for r in got})
