"""SuperMinHash near-duplicates against brute force over all pairs."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import minhash as mh


def brute_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(tuple(w) for w in [w] if w)


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                if find(a) != find(b) and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        comp[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return sorted((str(i), len(sets[a]), str(low.get(find(a))), i == low.get(find(a))) for a, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    out = got(se.queries()["op13_minhash_near_dedup"](spark, d))
    assert out == brute(rows)
    assert any(not r[3] for r in out)


def words(at, n):
    return [f"w{at}x{i}" for i in range(n)]


def test_planted_chains_and_borders(spark):
    """Pairs at, above and below 0.8, and a chain whose ends are not alike."""
    rows, at = [], 0
    for n in (9, 45, 90):
        base = words(n, n + 1)                                    # n shingles
        rows += [(at, " ".join(base)), (at + 1, " ".join(base[:-(n // 9)] + words(at + 500, n // 9))),   # 8/10 of the union
                 (at + 2, " ".join(base[:-(n // 9) - 1] + words(at + 900, n // 9 + 1)))]                 # just below
        at += 10
    chain = words(7, 400)
    for i in range(8):
        rows.append((at + i, " ".join(chain[20 * i:20 * i + 250])))
    rows.append((at + 20, " ".join(chain[200:400])))
    out = brute(rows)
    assert got(mh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == out
    assert len({r[2] for r in out if int(r[0]) in range(at, at + 8)}) == 1


def test_large_buckets_in_chunks(spark):
    """A group of near copies larger than a bucket's and a chunk's bound."""
    rng = np.random.default_rng(3)
    base = words(1, 120)
    rows = []
    for i in range(300):
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 9), replace=False):
            w[k] = f"v{i}x{k}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(mh.near_duplicates(df, bucket_rows=20, chunk_bytes=20_000)) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One  two"), (5, "one two"), (5, "one two"), (None, "solo text here"),
            (7, "Été a b c"), (8, "été a b c"), (9, long), (10, long + " w"), (-3, "x"), (12, "X\t"), (None, "x"),
            (14, "one two three four five six seven eight nine ten"), (14, "totally different words in this one row")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("g", F.lit("x")).withColumn("root", F.lit(1)) \
        .withColumn("th", F.lit(2)).withColumn("keys", F.lit(3))
    out = [r if r[2] != "None" else (*r[:3], True) for r in brute(rows)]  # a class without ids is kept
    assert got(mh.near_duplicates(df)) == sorted(out)
    assert mh.near_duplicates(df.limit(0)).collect() == []
    text_ids = mh.near_duplicates(spark.createDataFrame([("b", "p q r"), ("a", "p q r")], "doc_id string, text string"))
    assert got(text_ids) == [("a", 2, "a", True), ("b", 2, "a", False)]


def test_signature_estimates_and_is_stable():
    """Equal slots estimate the similarity, with less spread than independent
    hashes; a set dealt in parts has the same signature."""
    rng = np.random.default_rng(1)
    share = []
    for _ in range(200):
        u = rng.integers(0, 2**63, 400).astype(np.uint64)
        s = mh.signatures([np.unique(u[:360]), np.unique(u[40:])])
        share.append((s[0] == s[1]).mean())
    assert abs(np.mean(share) - 0.8) < 0.01
    assert np.std(share) < 0.034
    big = np.unique(rng.integers(0, 2**63, 100_000).astype(np.uint64))
    whole = mh.signatures([big])
    parts = np.full((1, 128), mh.EMPTY, dtype=np.uint64)
    for x in np.array_split(big, 7):
        mh._deal(parts, [(0, x)], 128)
    assert (whole == parts).all()
