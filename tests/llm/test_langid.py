"""Language ID: encoding against its definition, held-out accuracy, edge rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import langid as li
from kindred.llm.common import BATCH, small_batches


def test_encoding_is_the_sum_of_bound_trigrams():
    e = li.Encoder(64, 3)
    chars = [0] + [ord(c) if c != " " else 0 for c in "à la été x"] + [0]
    want = np.zeros(64)
    for a, b, c in zip(chars, chars[1:], chars[2:]):
        want += np.roll(e.letter(a)[2], 2) * np.roll(e.letter(b)[2], 1) * e.letter(c)[2]
    assert np.array_equal(e.encode("À la 12 --été,\n X."), want)
    assert e.encode("12 ?!") is None and e.encode("") is None and e.encode(None) is None


def test_cache_and_blocks_do_not_change_vectors(monkeypatch):
    text = "The quick brown fox jumps over the lazy dog ünd so weiter " * 30_000  # over one block
    want = li.Encoder(64, 3).encode(text)
    monkeypatch.setattr(li, "CACHE_ROWS", 4)
    assert np.array_equal(li.Encoder(64, 3).encode(text), want)
    half = li.Encoder(64, 3).encode("the quick brown fox jumps over the lazy dog ünd so weiter " * 15_000)
    assert np.dot(half, want) / np.linalg.norm(half) / np.linalg.norm(want) > 0.999


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    out = se.queries()["op6_language_id"](spark, d).join(
        spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.lang]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "xx"),
            (5, "123 !!", "de"), (None, "the cat and the dog", None), (1, "the cat and the dog", "en"),
            (7, "the dog and the cat " * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("q")) \
        .withColumn("row", F.lit(2))
    labels, proto = li.fit(df, dim=256)
    assert labels == ["de", "en", "xx"]
    got = li.predict(df, labels, proto)
    assert set(got.columns) == {"doc_id", "text", "lang", "row", "lang_pred", "score"}
    assert sorted((str(r.doc_id), r.lang_pred) for r in got.collect()) == sorted(
        [("1", "en"), ("2", "de"), ("3", "und"), ("4", "und"), ("5", "und"), ("None", "en"), ("1", "en"), ("7", "en")])
    empty = df.limit(0)
    none, zero = li.fit(empty, dim=16)
    assert none == [] and li.predict(empty, none, zero).collect() == []
    assert {r.lang_pred for r in li.predict(df, none, zero).collect()} == {"und"}


def test_query_equals_profiles_recomputed(spark):
    """The whole query against prototypes and cosines computed text by text:
    at this size every training row is read."""
    d, dim, seed = "/root/testdata/sf0.001", 512, 7
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    vectors, grams = {}, {}

    def vector(c):
        if c not in vectors:
            vectors[c] = np.random.default_rng([seed, c]).integers(0, 2, dim) * 2 - 1
        return vectors[c]

    def profile(text):
        codes = [0]
        for ch in (text or "").lower():
            c = ord(ch) if ch.isalpha() else 0
            if c or codes[-1]:
                codes.append(c)
        if codes[-1]:
            codes.append(0)
        if not any(codes):
            return None
        total = np.zeros(dim)
        for g in zip(codes, codes[1:], codes[2:]):
            if g not in grams:
                grams[g] = np.roll(vector(g[0]), 2) * np.roll(vector(g[1]), 1) * vector(g[2])
            total += grams[g]
        return total

    def unit(v):
        return v / np.linalg.norm(v)

    def held(r):
        return zlib.crc32(str(r.doc_id).encode()) % 5 == 0

    seen = {r.doc_id: profile(r.text) for r in docs}
    labels = sorted({r.lang for r in docs if r.lang is not None and not held(r)})
    proto = {k: unit(sum(unit(seen[r.doc_id]) for r in docs if r.lang == k and not held(r) and seen[r.doc_id] is not None)) for k in labels}
    mean = sum(proto.values()) / len(labels)
    got = {r.doc_id: r for r in se.queries()["op6_language_id"](spark, d).collect()}
    assert len(got) == len(docs) and len(labels) > 2
    for r in docs:
        v, out = seen[r.doc_id], got[r.doc_id]
        assert out.held_out == held(r)
        if v is None:
            assert (out.lang_pred, out.score) == ("und", 0.0)
            continue
        own = unit(v) - mean
        cos = {k: float(unit(proto[k] - mean) @ unit(own)) for k in labels}
        best = max(cos.values())
        assert cos[out.lang_pred] > best - 1e-6 and abs(out.score - min(1.0, max(0.0, best))) < 1e-5


def test_every_labelled_row_is_learnt_from(spark):
    """Prototype and usual score over 2600 rows of a label; before, about 2000 were read."""
    words = ["the", "cat", "dog", "house", "runs", "over", "green", "hills"]
    texts = [" ".join(words[(i >> k) % 8] for k in range(0, 12, 3)) for i in range(2600)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels, proto = li.fit(docs, dim=64)
    enc = li.Encoder(64, 7)
    seen = [enc.counted(t) for t in texts]
    units = [v / np.linalg.norm(v) for v, _ in seen]
    whole = np.sum(units, axis=0)
    assert labels == ["en"] and np.allclose(proto[0], whole / np.linalg.norm(whole), atol=1e-8)
    own = [v @ (whole - u) / np.linalg.norm(whole - u) / n for (v, n), u in zip(seen, units)]
    assert abs(li.typical(docs, labels, proto)[0] - np.median(own)) < 1e-4
    assert li.typical(docs.limit(1), labels, proto)[0] == -np.inf


def test_workers_keep_small_vectors_and_get_small_batches(spark):
    """A byte an entry of the cached trigrams, and at most 1000 texts a batch unless set otherwise."""
    enc = li.Encoder(64, 7)
    enc.encode("the quick brown fox")
    assert enc.cache.dtype == np.int8 and len(enc.rows) > 10
    before = spark.conf.get(BATCH, "10000")
    try:
        for old, new in (("10000", "1000"), ("77", "77")):
            spark.conf.set(BATCH, old)
            with small_batches(spark):
                assert spark.conf.get(BATCH) == new
            assert spark.conf.get(BATCH) == old
    finally:
        spark.conf.set(BATCH, before)
