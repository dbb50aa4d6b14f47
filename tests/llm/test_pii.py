"""Base spans against the plain patterns; the trees on planted loose forms."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import array_to_vector, vector_to_array

import __spark_entry__ as se
from kindred.llm import boosting, pii


def plain(text):
    """The patterns as stated, by backtracking."""
    text = text or ""
    out = [("email", m.start(), m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, p in (("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = [int(c) for c in m.group() if c.isdigit()]
            s = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
            if (16 <= len(d) <= 19 and s % 10 == 0) if kind == "card" else 8 <= len(d) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.9-+ (0é%1", max_size=40) | st.text(alphabet="0123456789.- +", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_examples():
    text = "é 4111 1111 1111 1111, a.b+c@x-y.co.uk@z.de 1.2.3.4.5.6.7.8 256.1.1.1 +1 (555) 555-1234. 0001.1.1.1"
    assert pii.base_spans(text) == plain(text) and len(plain(text)) >= 5
    long = "9" * 200_000 + "a" * 200_000 + "@" + "." * 100_000 + "+1" + "(" * 100_000
    assert pii.base_spans(long) == []


def test_query_matches_patterns(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = se.queries()["op3_pii_boosting"](spark, d).collect()
    assert len(out) == len(docs)
    for r in out:
        want = plain(docs[r.doc_id])
        names = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.KINDS]
        assert set(names) <= set(r.spans.split(",")) | {""} or not names


def corpus(n):
    rng, rows = random.Random(4), []
    for i in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "look", "at", "the"]) for _ in range(30)]
        kind = i % 6
        d = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if pii.luhn(d + c))
        words.insert(rng.randrange(30), [f"joe.{d[:3]}@mail{d[3]}.example.com", f"{int(d[:2])}.{int(d[2:4])}.{d[4]}.7", card,
                                         f"+1 ({d[:3]}) 555-{d[3:7]}", d[:14], d[:9]][kind])
        rows.append((i, " ".join(words)))
    return rows


def test_trees_add_loose_forms_and_leave_numbers(spark):
    df = spark.createDataFrame(corpus(1500), "doc_id long, text string")
    fitted = pii.fit(df)
    assert fitted and {"email", "card"} <= set(fitted[1])
    texts = [(1, "alpha beta joe.123 at mail4 dot example dot com gamma"), (2, "gamma order 123456789 delta"),
             (3, "alpha look at the delta"), (4, None), (5, ""), (4, None), (None, "x joe@mail.example.com y")]
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in
           pii.find(spark.createDataFrame([(i, t, "b") for i, t in texts], "doc_id long, text string, base string"), fitted).collect()]
    spans = {i: s for i, s in got}
    assert len(got) == 7 and spans[1] == [("email", 11, 47)] and spans[None] == [("email", 2, 22)]
    assert not (spans[2] or spans[3] or spans[4] or spans[5])
    assert pii.redact(texts[0][1], spans[1]) == "alpha beta [EMAIL] gamma"


def test_small_or_empty_samples_fit_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert pii.fit(df) is None and pii.fit(df.limit(0)) is None
    assert pii.find(df.limit(0), None).collect() == []


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = boosting.calibrate(boosting.fit(x[:3000], y[:3000]), x[3000:], y[3000:])
    p = m.probability(x[3000:])
    assert np.mean((p > 0.5) == (y[3000:] > 0.5)) > 0.97 and abs(p.mean() - y[3000:].mean()) < 0.02


def test_spelled_out_separators_in_any_case_and_long_local_parts():
    long = "x" * 100
    assert ("email", 0, 112) in pii.candidates(f"{long}[at]mail.com")
    for said in ("[At]", "(aT)", " At ", "[AT]"):
        assert any(k == "email" and a == 4 for k, a, _ in pii.candidates(f"ask joe{said}mailx.com now"))


def plain_runs(text):
    """Secret runs as stated: each maximal run, with up to two signs behind."""
    out, k, ok = [], 0, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-"
    while k < len(text):
        end = k
        while end < len(text) and text[end] in ok:
            end += 1
        if end - k >= 16:
            run = text[k:end]
            for _ in range(2):
                end += text[end:end + 1] == "="
            if any("0" <= c <= "9" for c in run) and any(c not in "0123456789_+/-" for c in run):
                out.append(("secret", k, end))
        k = max(end, k + 1)
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a1b2", "c", "99999999", "=", "-", '"', " ", "token", "key = ", "Key:'", "zzzzzzzz", "é"]), max_size=16))
def test_secret_generators(parts):
    text = "".join(parts)
    runs = pii.secret_runs(text)
    assert runs == plain_runs(text) and set(runs) <= set(pii.candidates(text))
    named = [s for s in runs if text[s[2]:s[2] + 1] in ("'", '"')
             and re.search(r"(?i)(token|key|secret|password|passwd|pwd)[\"']?[ \t]*[:=][ \t]*[\"']$", text[:s[1]])]
    assert pii.named_secrets(text) == named


def test_secrets_of_the_tables_are_added(spark):
    """Added secrets are the quoted values of names, no more and no fewer."""
    d = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    want = {(i, f"secret:{m.start(1)}:{m.end(1)}") for i, t in docs.items()
            for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t or "")}
    out = se.queries()["op3_pii_boosting"](spark, d).collect()
    got = {(r.doc_id, s) for r in out for s in r.spans.split(",") if s.startswith("secret:")}
    assert len(want) > 50 and got == want
    for r in out:
        n = r.n_email + r.n_ip + r.n_card + r.n_phone
        assert r.flagged == (n + r.n_added > 0) and r.n_secret == sum(i == r.doc_id for i, _ in got if i == r.doc_id) <= r.n_added


def test_every_candidate_of_every_document_is_fitted(spark, monkeypatch):
    """Before, at most 50 spans of a document and about 20 000 documents were read."""
    long = " ".join(f"joe{i}@mail.example.com" for i in range(120))
    assert sum(y for _, y, _, _ in pii.training_rows(long, "k")) == 240
    seen = {}

    def fit_rows(rows):
        seen["n"] = rows.groupBy().sum("n").first()[0]
        return boosting.Trees(np.zeros((1, 1), dtype=np.int64), np.zeros((1, 1)), np.zeros((1, 2)))

    monkeypatch.setattr(boosting, "fit_rows", fit_rows)
    texts = [long] + [f"a{i} joe@mail.example.com {i} b" for i in range(21_000)]
    want = sum(not h for t in texts for _, _, h, _ in pii.training_rows(t, t[:200]))
    pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert seen["n"] == want > 30_000


def test_trees_of_spark_give_its_margins(spark):
    """Rows counted as often as they stand for, and the same sums in both forms."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, size=(600, 4)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b), float(1 + i % 3)) for i, (a, b) in enumerate(zip(x, y))],
                                 "x array<double>, y double, n double")
    kept = []
    real = boosting.stored_nodes
    boosting.stored_nodes = lambda model: kept.append(model) or real(model)
    try:
        trees = boosting.fit_rows(rows, trees=8)
    finally:
        boosting.stored_nodes = real
    raw = kept[0].transform(rows.select(array_to_vector("x").alias("features"))).select(vector_to_array("rawPrediction")[1]).collect()
    assert np.allclose(trees.raw(x), [r[0] / 2 for r in raw], atol=2e-3) or np.allclose(trees.raw(x), [r[0] for r in raw], atol=2e-3)
    m = boosting.calibrate_sums(trees, trees.raw(x), y, np.ones(len(y)))
    assert np.mean((m.probability(x) > 0.5) == (y > 0.5)) > 0.95
