"""Connected components against union-find."""

import random

from kindred.llm.common import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_paths_stars_and_random_edges(spark):
    rng = random.Random(3)
    ids = list(range(-400, 400))
    rng.shuffle(ids)
    edges = list(zip(ids[:80], ids[1:81]))                       # a path in random order
    edges += [(ids[100], x) for x in ids[101:300]]               # a star
    edges += [(rng.choice(ids[300:500]), rng.choice(ids[300:500])) for _ in range(120)]
    edges += [(7, 7), edges[0], edges[0][::-1]]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == brute(edges)
    assert components(df.limit(0)).collect() == []
