"""SimHash against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import simhash as sh
from kindred.llm.common import components


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute(rows):
    fps = [(i, brute_fp(t)) for i, t in rows]
    comp = list(range(len(fps)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 3:
                comp[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(fps):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return sorted((str(i), f"{f:016x}", low.get(find(a))) for a, (i, f) in enumerate(fps))


def got(df):
    return sorted((str(r.doc_id), f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect())


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    out = se.queries()["op8_simhash_near_dedup"](spark, d).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in out) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One  two"), (5, "one two"), (5, "one two"), (None, "solo text here"),
            (7, "Été a b c"), (8, "été a b c"), (9, long), (10, long + " w")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    assert got(sh.near_duplicates(df)) == brute(rows)
    assert sh.near_duplicates(df.limit(0)).collect() == []


def test_links_in_chunks_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-2**63, 2**63 - 1, 6, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base[:3]:
        x = b
        for _ in range(60):
            x = x ^ np.int64(1 << int(rng.integers(0, 62)))
            fps.add(int(x))
    want = {frozenset(g) for g in groups(fps)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for rows in (4, 4096):
        cc = components(sh.links(df, 3, 5, bucket_rows=rows)).collect()
        by = {}
        for r in cc:
            by.setdefault(r.root, set()).add(r.node)
        assert {frozenset(v) for v in by.values()} == want
        assert all(min(v) == k for k, v in by.items())


def groups(fps):
    left, out = set(fps), []
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x = todo.pop()
            seen.add(x)
            near = {y for y in left if bin((x ^ y) & (1 << 64) - 1).count("1") <= 3}
            left -= near
            todo += near
        if len(seen) > 1:
            out.append(seen)
    return out


def test_every_bit_counts_once():
    for x in (0, 5, -1, -2**63, 0x61F693C8F18DE383):
        for k in range(64):
            for other in (1, 1 << (k + 1) % 64, 1 << (k + 1) % 64 | 1 << (k + 7) % 64):
                pair = np.array([x & (1 << 64) - 1, (x ^ (1 << k) ^ other) & (1 << 64) - 1], dtype=np.uint64).view(np.int64)
                want = [] if pair[0] == pair[1] else [(int(pair.min()), int(pair.max()))]
                assert sh.stars(pair, 3) == want
    assert sh.stars(np.array([0, -1], dtype=np.int64), 3) == []
    assert sh.stars(np.array([0, -2**63 + 7], dtype=np.int64), 3) == []


def test_one_row_of_each_component_with_null_and_repeated_ids(spark):
    a, b, c, d = ("the cat sat on the mat", "le chat dort sur le lit", "der Hund ist im Haus heute", "el perro come pan cada dia")
    rows = [(None, a), (None, b), (None, b), (3, c), (3, d), (3, d), (4, c), (None, d)]
    assert len({brute_fp(t) for t in (a, b, c, d)}) == 4 and len({x[2] for x in brute([(i, t) for i, t in enumerate((a, b, c, d))])}) == 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in sh.one_of_each(df).collect())
    assert got == sorted([("None", a), ("None", b), ("3", c), ("3", d)])


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_masks_cover(blocks):
    masks = [m & (1 << 64) - 1 for m in sh.block_masks(blocks, 3)]
    rng = np.random.default_rng(1)
    for _ in range(200):
        flip = sum(1 << int(i) for i in set(rng.integers(0, 64, 3)))
        assert any(flip & m == 0 for m in masks)
