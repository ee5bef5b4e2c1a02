"""Connected components by hooking and contraction."""

import random

from sideline.llm.common import connected_components


def _brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def test_shapes(spark):
    rnd = random.Random(0)
    shapes = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)], "random": [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)],
              "odd": [(None, 1), (2, None), (3, 3), (4, 5), (5, 4), (4, 5), (-1, 5)]}
    for name, edges in shapes.items():
        rnd.shuffle(edges)
        found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert found == _brute(edges), name


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
