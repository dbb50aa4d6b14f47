"""Nearest neighbours against brute force."""

import numpy as np
import pytest

import __spark_entry__ as se
from kindred.llm import ann


def brute(rows, pick, k=10):
    """rows: (id, vector). {query: [(distance, id)]}"""
    out = {}
    for q, v in rows:
        if pick(q):
            least = {}
            for i, w in rows:
                if i != q:
                    d = float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum()))
                    least[i] = min(d, least.get(i, d))
            out[q] = sorted((d, i) for i, d in least.items())[:k]
    return out


def by_query(out):
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()
            if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    got = by_query(se.queries()["op7_nearest_neighbours"](spark, d).collect())
    want = brute(rows, lambda i: i % 100 == 0)
    assert set(got) == set(want) and all(len(got[q]) == 10 for q in got)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    vec = dict(rows)
    for q, near in got.items():
        assert near == sorted(near)
        assert all(s == np.sqrt(((np.array(vec[i]) - np.array(vec[q])) ** 2).sum()) for s, i in near)


def test_whole_search_is_exact_with_copies_and_small_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(150)] + [(i, [1.0, 0.0, 0.0, 0.5]) for i in range(150, 260)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest(df, query="id % 50 = 0", leaf_rows=8, search_share=8.0, block_rows=5).collect()
    assert by_query(out) == brute(rows, lambda i: i % 50 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0]), (8, []), (100, [1.0, 0.0]), (200, None), (9, [2.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, id int")
    out = by_query(ann.nearest(df).collect())
    good = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0]), (9, [2.0, 0.0])]
    assert out == brute(good, lambda i: i % 100 == 0)
    assert ann.nearest(df.limit(0)).collect() == []
