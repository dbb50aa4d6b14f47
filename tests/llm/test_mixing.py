"""Mixing: budgets against plain water filling, whole query against SQL."""

import pytest

import __spark_entry__ as se
from kindred.llm import mixing as mx
from oracle_util import compare, duck


def fill(children, budget):
    """children: {name: (weight, cap)}; repeated rounds over the unfilled."""
    got, left, live = dict.fromkeys(children, 0.0), budget, {k for k, (w, c) in children.items() if w > 0}
    while live and left > 1e-9:
        unit = left / sum(children[k][0] for k in live)
        done = {k for k in live if got[k] + unit * children[k][0] >= children[k][1] - 1e-9}
        for k in live:
            add = min(unit * children[k][0], children[k][1] - got[k])
            got[k] += add
            left -= add
        live -= done
    return got


def rows_of(spark, spec):
    """spec: (doc_id, lang, source, words)"""
    return spark.createDataFrame([(i, None if n is None else "w " * n, la, so, i or 0, 1) for i, la, so, n in spec],
                                 "doc_id long, text string, lang string, source string, n_chars long, tokens int")


SPEC = [(i, la, f"s{s}", 3 + (i * 7) % 11) for i, (la, s) in enumerate(
    [("en", 0)] * 60 + [("en", 4)] * 3 + [("de", 0)] * 2 + [("fr", 1)] * 10 + [("en", 1)] * 5 + [("es", 2)] * 1)]
MIX = mx.Mix(0.8, 3, "t", {"domain": {"domain1": 5}, "lang": {"de": 4}})


def test_budgets(spark):
    docs = rows_of(spark, SPEC)
    got = {(r.domain, r.lang, r.source): (r.have, r.budget) for r in
           mx.source_budgets(docs.select("doc_id", *mx.tree_columns(docs, MIX)), MIX).collect()}
    have = {}
    for i, la, so, n in SPEC:
        k = (f"domain{int(so[1:]) % 4}", la, so)
        have[k] = have.get(k, 0) + n
    cap = {k: 3 * v for k, v in have.items()}
    top = fill({d: (MIX.weights["domain"].get(d, 1), sum(c for k, c in cap.items() if k[0] == d))
                for d in {k[0] for k in cap}}, int(0.8 * sum(have.values())))
    want = {}
    for d, b in top.items():
        mid = fill({x: (MIX.weights["lang"].get(x, 1), sum(c for k, c in cap.items() if k[:2] == (d, x)))
                    for x in {k[1] for k in cap if k[0] == d}}, b)
        for x, bx in mid.items():
            want.update(((d, x, s), v) for s, v in fill({k[2]: (1, c) for k, c in cap.items() if k[:2] == (d, x)}, bx).items())
    assert {k: v[0] for k, v in got.items()} == have
    assert all(abs(got[k][1] - want[k]) <= 1 for k in want)
    assert sum(v[1] for v in got.values()) >= int(0.8 * sum(have.values())) - len(got)


def test_weight_of_zero_hands_its_share_on(spark):
    docs = rows_of(spark, SPEC)
    mix = mx.Mix(0.5, 3, "t", {"lang": {"en": 0}, "domain": {"domain0": 9}})
    got = mx.source_budgets(docs.select("doc_id", *mx.tree_columns(docs, mix)), mix).collect()
    total, room = sum(n for *_, n in SPEC), sum(3 * r.have for r in got)
    assert {r.lang for r in got} == {"de", "fr", "es"}
    assert abs(sum(r.budget for r in got) - min(total // 2, room)) <= len(got)


def test_prefixes(spark):
    docs = rows_of(spark, SPEC)
    budget = {(r.domain, r.lang, r.source): r.budget for r in
              mx.source_budgets(docs.select("doc_id", *mx.tree_columns(docs, MIX)), MIX).collect()}
    out = mx.mix_rows(docs, MIX, docs.columns).collect()
    size = {i: n for i, _, _, n in SPEC}
    for k, b in budget.items():
        own = [r for r in out if (r.domain, r.lang, r.source) == k]
        used = sum(r.tokens for r in own)
        assert b - max(size.values()) < used <= b
        assert len({(r.doc_id, r.epoch) for r in own}) == len(own)


def test_edge_rows(spark):
    spec = [(1, None, None, 5), (1, None, None, 5), (None, "en", "s0", 4), (3, "en", "", None), (4, "", "odd", 0),
            (5, "en", "s0", 200_000), (6, "en", "s" + "9" * 30, 2)]
    docs = rows_of(spark, spec)
    out = mx.mix_rows(docs, mx.Mix(2.0, 2, "t"), docs.columns).collect()
    assert len(out) == 10 and {r.doc_id for r in out} == {1, None, 5, 6}  # each row with tokens, twice
    none = mx.Mix(1.0, 2, "t", {"lang": {"en": 0}})
    assert {r.doc_id for r in mx.mix_rows(docs, none, docs.columns).collect()} == {1}
    assert mx.mix_rows(docs.limit(0), MIX, docs.columns).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, sf):
    d = f"/root/testdata/{sf}"
    assert compare(se.queries()["op9_mix_to_weights"](spark, d), duck(d), se.oracle_sql()["op9_mix_to_weights"])[0] == []
