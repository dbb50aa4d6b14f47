"""Decontamination against brute force and the SQL oracle."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import decontaminate as dec
from oracle_util import compare, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))


def brute(docs, items, size=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for j, x in items:
            v = words(x)
            n = min(size, len(v))
            for s in range(len(v) - n + 1 if v else 0):
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == v[s:s + n]:
                        hit |= set(range(at, at + n))
                        ids |= {str(j)} - {"None"}
        out.append((str(i), len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out)


DOCS = [(1, None), (2, ""), (3, "One two"), (4, "x one TWO three. four five six seven eight nine ten y"),
        (5, "a b"), (5, "a b"), (None, "zz a b zz a b"), (0, "nothing"), (7, "rep " * 40), (8, "w " * 30_000 + "a b"),
        (9, "été one two three four five six seven eight nine Ten")]
ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "a b"), (4, "A, b!"), (None, "nothing"),
         (5, "rep rep rep rep rep rep rep rep rep rep rep"), (6, "?!"), (7, "été one two three four five six seven eight nine")]


def rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect())


@pytest.mark.parametrize("limit", [500_000, 0])
def test_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(dec, "BROADCAST_ROWS", limit)
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in DOCS], "doc_id long, text string, d int, p string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, t int")
    assert rows(dec.scan(docs, items)) == brute(DOCS, ITEMS)
    kept = dec.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in brute(DOCS, ITEMS) if not r[4])


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(dec.scan(docs.limit(0), items)) == []
    assert not any(r[4] for r in rows(dec.scan(docs, items.limit(0))))


def near_brute(docs, items, size=10, slop=2):
    """{id of document: items with a window all of whose words have a document
    word equal to them at most ``slop`` places from where it should stand}"""
    out = {}
    for i, t in docs:
        places, n_words = {}, len(words(t))
        for k, w in enumerate(words(t)):
            places.setdefault(w, set()).update(range(k - slop, k + slop + 1))
        for j, x in items:
            v = words(x)
            n = min(size, len(v))
            if j is not None and any(all(at + o in places.get(v[s + o], ()) for o in range(n))
                                     for s in range(len(v) - n + 1 if v else 0) for at in range(-slop, n_words + slop)):
                out.setdefault(str(i), set()).add(str(j))
    return out


NEAR = [(20, "one TWO, and three four five six seven eight nine ten"), (21, "two one four three six five eight seven ten nine"),
        (22, "one two x x x x x three four five six seven eight nine ten"), (23, "b zz a"), (24, "b zz zz zz zz a"),
        (25, "three four five x six seven y eight nine ten eleven one two"), (26, "rep x rep rep rep rep rep rep rep rep rep"),
        (27, "eleven ten nine eight seven six five four three two one"), (28, "a"), (29, "a b " * 300 + "one two")]


@pytest.mark.parametrize("slop,limit", [(0, 500_000), (2, 500_000), (3, 0)])
def test_proximity(spark, monkeypatch, slop, limit):
    monkeypatch.setattr(dec, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(dec, "FILTER_SLOTS", 4)
    monkeypatch.setattr(dec, "MOST_SLOTS", 8)
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in DOCS + NEAR], "doc_id long, text string, at int, s string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, len int")
    found = dec.scan(docs, items, slop=slop).collect()
    want = near_brute(DOCS + NEAR, ITEMS, slop=slop)
    assert {str(r.doc_id): set(r.near_item_ids) for r in found if r.n_near_items} == want
    assert all(set(r.item_ids) <= set(r.near_item_ids) and r.n_near_items == len(r.near_item_ids) for r in found)
    ix = dec.build_index(docs, items)
    exact, near = ({(r.d, r.h, r.p) for r in m.collect()} for m in (dec.exact_matches(ix), dec.proximity_matches(ix, slop=slop)))
    assert exact == near if slop == 0 else exact < near


def test_proximity_at_random(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(60)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abcdef", [9, 5, 3, 2, 1, 1], k=rng.randrange(1, 9)))) for i in range(15)]
    got = dec.scan(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                   window=5, slop=1).collect()
    assert {str(r.doc_id): set(r.near_item_ids) for r in got if r.n_near_items} == near_brute(docs, items, 5, 1)


def test_oracle(spark):
    d = "/root/testdata/sf0.001"
    name = "op2_benchmark_decontamination"
    assert compare(se.queries()[name](spark, d), duck(d), se.oracle_sql()[name])[0] == []


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "the blue fox ran"), (None, "the blue fox ran"), ("a", "no hit"), ("7", "blue fox")], "doc_id string, text string") \
        .withColumn("d", F.lit("x")).withColumn("h", F.lit("y"))
    items = spark.createDataFrame([(1, "blue fox"), (None, "ran")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in dec.scan(docs, items).collect()}
    assert got == {"b": (3, 1), None: (3, 1), "a": (0, 0), "7": (2, 1)}
    assert {r.doc_id for r in dec.clean(docs, items).collect()} == {"a"}
