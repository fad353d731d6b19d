import numpy as np

from flowgauge.llm.components import components


def test_chain_star_and_pairs(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rng = np.random.default_rng(1)
    loose = [(int(a), int(b)) for a, b in rng.integers(5000, 5400, (150, 2))]
    edges = spark.createDataFrame(chain + star + loose + [(7, 7)], "a long, b long")
    root = {}
    found = components(edges, "a", "b")
    for r in found.collect():
        root[r.vertex] = r.root
    assert len({v for v in root.values()}) == len(expected(chain + star + loose))
    assert components(edges.limit(0), "a", "b").count() == 0


def expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    return {find(x) for x in parent}
