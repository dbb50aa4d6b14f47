"""The pipeline stage by stage against brute force."""

import random
import string
from collections import Counter

import pytest

import corpus_pipeline as cp
from kindred.llm import langid, mixing
from kindred.llm.common import staged, table
from test_decontaminate import brute as brute_hits
from test_lines import brute as brute_lines, pieces
from test_simhash import brute as brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        nxt = staged(stage(spark, docs, SF), "test")
        out.append((docs, nxt))
        docs = nxt
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(spark, steps):
    docs = table(spark, SF, "documents")
    assert all(after.columns == docs.columns for _, after in steps[:-1])
    assert [s[0] for s in cp.STAGES][0] == "language_id" and len(cp.STAGES) == 5


def test_language(steps):
    before, after = steps[0]
    labels, proto = langid.fit(before)
    enc = langid.Encoder(proto.shape[1], 7)
    keep = [(i, t) for i, t in pairs(before) if langid.classify(enc.encode(t), labels, proto)[1] > 0]
    assert sorted(keep) == sorted(pairs(after))


def test_lines(steps):
    before, after = steps[1]
    want = {i: t for i, t, k in brute_lines(pairs(before), lambda t: pieces(t, 3))
            for t in [k] if k.strip() or k == t}
    assert {str(i): t for i, t in pairs(after)} == {i: t for i, t in want.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_dedup(steps):
    before, after = steps[2]
    assert sorted(str(i) for i, _ in pairs(after)) == sorted({str(c) for _, _, c in brute_groups(pairs(before))})


def test_decontamination(spark, steps):
    before, after = steps[3]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert sorted(str(i) for i, _ in pairs(after)) == sorted(r[0] for r in brute_hits(pairs(before), items) if not r[4])


def test_mixing(spark, steps):
    before, after = steps[4]
    rows = after.collect()
    budget = {(r.domain, r.lang, r.source): r.budget for r in mixing.source_budgets(
        before.select("doc_id", *mixing.tree_columns(before, cp.MIX)), cp.MIX).collect()}
    used, top = Counter(), {}
    for r in rows:
        used[r.domain, r.lang, r.source] += r.tokens
        top[r.domain, r.lang, r.source] = max(r.tokens, top.get((r.domain, r.lang, r.source), 0))
    texts = dict(pairs(before))
    assert all(texts[r.doc_id] == r.text for r in rows)
    assert all(used[k] <= b for k, b in budget.items())


def test_edge_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s1", 0), (3, "the cat sat", "en", None, 11), (3, "the cat sat", "en", None, 11),
            (None, "le chat dort", None, "s2", 12), (None, "le chat dort", "fr", "s2", 12), (5, "123", "en", "s1", 3),
            (6, "a\nb\nc", "en", "s1", 5), (7, "a\nb\nc", "en", "s1", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), "test")
            assert docs.columns == cp.COLUMNS
        ids = [r.doc_id for r in docs.collect()]
        assert sorted(map(str, ids)) == (["3", "6", "None"] if data else [])
        assert cp.STAGES[-1][1](spark, docs, SF).count() >= 0


def test_language_stage_rejects_noise_and_keeps_short_texts(spark):
    rng = random.Random(3)
    docs = table(spark, "/root/testdata/sf0.01", "documents").select(*cp.COLUMNS)
    texts = [r.text for r in docs.select("text").collect()]
    noise = [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n)) for n in (40, 100, 400) * 10]
    clean = [t for t in (" ".join(rng.choice(texts).split()[:n]) for n in (1, 2, 5, 10, 40) * 20) if any(map(str.isalpha, t))]
    extra = [(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(noise + clean)]
    out = cp.language_stage(spark, docs.union(spark.createDataFrame(extra, docs.schema)), SF)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert not ids & {10**9 + i for i in range(len(noise))}
    assert ids >= {10**9 + len(noise) + i for i in range(len(clean))}
    assert ids >= {r.doc_id for r in docs.collect()}
