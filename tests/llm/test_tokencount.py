"""Edit-aware counts against encoding the whole text again."""

import random

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as se
from kindred.llm import tokencount as tc

TOK = tc.tokenizer(tc.TOKENIZER)
FULL = tiktoken.Encoding("full", pat_str=tc.PATTERN, mergeable_ranks=TOK.piece._mergeable_ranks, special_tokens={})
CHARS = "ab 'sreL1é\n  .!\u00a0\U0001f600"


def check(tree, text):
    pieces = [m.group() for m in TOK.cut.finditer(text)]
    lengths, counts = tree.leaves()
    assert lengths.tolist() == [len(p) for p in pieces]
    assert tree.total() == len(FULL.encode_ordinary(text)) == counts.sum()
    assert int(tree.chars[1]) == len(text)


edit = st.tuples(st.integers(0, 320), st.integers(0, 12), st.text(alphabet=CHARS, max_size=8))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=CHARS, max_size=300), st.lists(st.lists(edit, max_size=5), min_size=1, max_size=3))
def test_edits_equal_a_new_count(text, rounds):
    old, tc.BLOCK = tc.BLOCK, 4
    try:
        tree = tc.build_tree(text, TOK)
        check(tree, text)
        for r in rounds:
            todo = tc.checked([(a, a + n, s) for a, n, s in r], len(text))
            text, _ = tc.apply_edits(tree, text, todo, TOK)
            check(tree, text)
        check(tc.TokenTree.from_bytes(tree.to_bytes()), text)
    finally:
        tc.BLOCK = old


def test_only_touched_regions_are_encoded():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "beta", "x9", "it's", "...", "\n\n"]) for _ in range(50_000))
    tree = tc.build_tree(text, TOK)
    todo = tc.checked([(a, a + 5, "new words") for a in range(1000, 200_000, 20_000)], len(text))
    new, recoded = tc.apply_edits(tree, text, todo, TOK)
    assert tree.total() == len(FULL.encode_ordinary(new)) and recoded < 12 * len(todo)


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = "word it's  \n 12345 " * 500 + "z" * 3000 + " " * 3000 + "end"
    want = tc.build_tree(text, TOK).to_bytes()
    for size in (16, 100, 1000):
        monkeypatch.setattr(tc, "READ", size)
        assert tc.build_tree(text, TOK).to_bytes() == want


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = se.queries()["op1_edit_token_counts"](spark, d).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        t = docs[r.doc_id] or ""
        new = tc.edited(t, tc.cleaning_edits(t))
        assert r.n_tokens == len(FULL.encode_ordinary(t)) and r.n_tokens_after == len(FULL.encode_ordinary(new))
        assert r.n_edits == len(tc.cleaning_edits(t)) and r.n_recoded <= 12 * r.n_edits + 12


def test_edge_rows(spark):
    rows = [(1, None, [(0, 1, "x")]), (2, "", [(0, 0, "new")]), (2, "", [(0, 0, "new")]), (None, "a b c", None),
            (4, "a b c", [(2, 99, None), (1, 3, "overlaps"), (None, 1, "x")]), (5, "w " * 300_000, [(5, 6, "q")])]
    df = spark.createDataFrame([(i, t, e, "z") for i, t, e in rows],
                               "doc_id long, text string, edits array<struct<start:long,end:long,replacement:string>>, tree string")
    built = tc.build(df)
    joined = built.join(df.select("doc_id", "edits").distinct(), "doc_id")
    out = {r.doc_id: r for r in tc.apply(joined).collect()}
    assert (out[1].text, out[1].n_tokens, out[1].n_edits) == (None, 0, 0)
    assert (out[2].text, out[2].n_tokens_before, out[2].n_tokens) == ("new", 0, 1)
    assert out[4].text == "aoverlaps c" and out[5].n_tokens_before == len(FULL.encode_ordinary("w " * 300_000))
    assert {r.doc_id: r.n_tokens for r in built.collect()}[None] == 3
    assert tc.apply(joined.limit(0)).collect() == []
