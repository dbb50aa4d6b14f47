"""Hard negatives against brute force and SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import negatives as ng
from oracle_util import compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10, k=2, low=80):
    """Over Python integers."""
    good = set()
    for i, v, l in rows:
        if i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v):
            good.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), l))
    out = []
    for i, v, l in good:
        if i % every:
            continue
        met = [(sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in good if j != i and len(w) == len(v)]
        mine = sorted((-s, j) for s, j, m in met if m == l)[:k]
        for s, j in sorted(set(mine)):
            s = -s
            near = sorted((-t, n) for t, n, m in met if m != l and low * s <= 100 * t <= 100 * s)[:k]
            out += [(i, j, r, n, s, -t) for r, (t, n) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, **args):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("key", F.lit(1)).withColumn("v", F.lit(2))
    return sorted(tuple(r) for r in ng.mine(df, anchor="id % 10 = 0", positives=2, negatives=2, **args).collect())


def vectors(n, dims, labels, seed=0, grain=8):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0.2, 0.5, (n, dims)) * grain) / grain  # coarse: many ties
    return [(int(i), [float(y) for y in v], int(rng.integers(labels))) for i, v in enumerate(x)]


def test_oracle_at_two_scales(spark):
    for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert compare(se.queries()["op11_hard_negatives"](spark, d), duck(d), se.oracle_sql()["op11_hard_negatives"])[0] == []


@pytest.mark.parametrize("args", [{}, {"block_rows": 16}, {"block_rows": 16, "broadcast_bytes": 0}])
def test_blocks_ties_and_shuffled_anchors(spark, args):
    rows = vectors(300, 3, 3)
    want = brute(rows)
    assert want and mined(spark, rows, **args) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 2, seed=2) + [
        (100, None, 1), (110, [1.0, None, 1.0, 1.0], 1), (120, [nan, 1.0, 1.0, 1.0], 0), (130, [inf, 1.0, 1.0, 1.0], 0),
        (140, [1.0, 1.0, 1.0, 1.0], None), (None, [9.0, 9.0, 9.0, 9.0], 1), (150, [], 1), (151, [], 1), (152, [], 0),
        (160, [1.0, 1.0], 0), (161, [1.0, 0.9], 0), (162, [0.9, 0.9], 1), (170, [0.0] * 4, 0), (-10, [0.5, 0.5, 0.5, 0.5], 1),
        (-20, [0.5, 0.5, 0.5, 0.5], 0), (180, [0.5] * 4, 1), (180, [0.5] * 4, 1), (190, [0.5] * 4, 1), (190, [0.25] * 4, 1),
        (7, [3.0] * 4, 0)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    alone = mined(spark, [(10, [1.0], 1)])
    assert alone == []
    with pytest.raises(ValueError):
        mined(spark, [(10, [1e30], 1), (11, [1.0], 1)])


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for dims, most in ((1, 3), (64, 200), (700, 30_000), (3000, 1 << 12), (5, 1 << 22)):
        a, b = (rng.integers(-most, most + 1, (7, dims)) for _ in range(2))
        a[0], b[0], b[1] = most, most, -most  # the extremes of the bound
        primes, width = ng.primes_for(dims, dims * most * most)
        assert (ng.exact_products(a, b, primes, width) == a @ b.T).all()
        assert (len(primes) > 1 or dims == 1) and all(width * (p // 2) ** 2 <= ng.EXACT for p in primes)
