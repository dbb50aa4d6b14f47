"""Line and window de-duplication against brute force and SQL."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from kindred.llm import lines as ln
from oracle_util import compare, duck


def pieces(text, size):
    """Windows of ``size`` lines as (start, end, unit)."""
    parts = [x.strip(" \t\r") for x in text.split("\n")]
    return [(n, n + size, tuple(parts[n:n + size])) for n in range(len(parts) - size + 1) if any(parts[n:n + size])]


def joined(text, least):
    """Units of lines with ``least`` words together, found by trying all."""
    parts = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x)) for x in text.split("\n")]
    n = len(parts)
    out = set()
    for a in range(n):
        if parts[a]:
            b = next((b for b in range(a + 1, n + 1) if sum(map(len, parts[a:b])) >= least), None)
            if b:
                out.add((a, b))
            else:
                out.add((next((c for c in range(a, -1, -1) if sum(map(len, parts[c:n])) >= least), 0), n))
    return [(a, b, tuple(tuple(p) for p in parts[a:b] if p)) for a, b in out]


def brute(rows, units):
    """rows: (doc_id, text). Returns kept text by row order."""
    seen, where = {}, []
    for i, t in sorted({r for r in rows if r[1]}, key=lambda r: (r[0] is None, r[0] or 0, text_hash(r))):
        for a, b, u in sorted(units(t)):
            where.append(((i, t), a, b, u))
            seen.setdefault(u, ((i, t), a))
    gone = {}
    for doc, a, b, u in where:
        first, at = seen[u]
        if doc != first or a >= at + b - a:
            gone.setdefault(doc, set()).update(range(a, b))
    return sorted((str(i), str(t), str("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) if t else t))
                  for i, t in rows)


HASHES = {}


def text_hash(row):
    return HASHES.get(row, 0)  # tells rows of one id apart; without such rows it may be missing


A, B, C, D = "one two three four five six", "b b b b b b", "Cee  c c c c c", "dee d d d d d"
ROWS = [(1, "\n".join([A, B, C, D])), (2, "\n".join(["x", A, B, C, "short"])), (3, "\n".join([B, C, D])), (4, None), (5, ""),
        (6, "\n\n\n\n\n"), (7, "\n".join(["aaa bbb ccc ddd eee"] * 8)), (None, "\n".join([A, B, C])), (9, A), (9, A),
        (10, f" {A.upper()} \n{B}\n  cee c c c c c"), (11, "\n".join(f"line {k} of a very long text" for k in range(20_000)))]


ROWS += [(-5, "\n".join([A, B, C])), (-1 << 40, "z\n" + D), (None, "\n".join([D, C, B, A])), (9, "\n".join([A, "other end", B])),
         (12, "short\nlines\nonly\n\nhere"), (13, "Short \n lines\nonly\nhere"), (14, "a b\n\nc d\n" * 30), (15, "\t\r\n  "),
         (16, "one\x0btwo\x0cthree\u00a0four\u2003five " * 3), (17, "ONE two three\u00a0FOUR\u2003five " * 3)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in ROWS], "doc_id long, text string, d int, lines string")
    for r in df.select("doc_id", "text", F.xxhash64(F.col("doc_id").isNull(), "text").alias("h")).collect():
        HASHES[(r[0], r[1])] = r.h
    return df


def kept(df):
    return sorted((str(r.doc_id), str(r.text), str(r.kept)) for r in df.collect())


def test_windows(docs):
    out = ln.window_dedup(docs, 3)
    assert out.columns[:4] == docs.columns
    assert kept(out) == brute(ROWS, lambda t: pieces(t, 3))


@pytest.mark.parametrize("least", [1, 7, 15])
def test_units(docs, least):
    assert kept(ln.unit_dedup(docs, least)) == brute(ROWS, lambda t: joined(t, least))


def test_text_ids(spark):
    rows = [("b", "\n".join([A, B, C])), ("a", "\n".join([A, B, C])), (None, "\n".join([A, B, C])), ("c", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for op in (ln.window_dedup, ln.unit_dedup):
        assert {r.doc_id: r.kept for r in op(df).collect()} == {"a": rows[0][1], "b": "", None: "", "c": None}


def test_short_stock_lines_stay_and_long_lines_go(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"stock line\n{long}\nfirst one has its own words here and goes on for a while to the end"),
            (2, f"stock line\nhere the second document says what only it can say in so many words\n{long}")]
    out = {r.doc_id: r.kept for r in ln.unit_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and out[2] == rows[1][1].rsplit("\n", 1)[0]


def test_empty(docs):
    assert ln.window_dedup(docs.limit(0)).collect() == [] and ln.unit_dedup(docs.limit(0)).collect() == []


def test_offsets():
    text = "ab\ncdé\n\nf"
    kept_text, n, lines, gone, left = ln.cut_text(text, [1, 2])
    assert (kept_text, n, lines, gone, left) == ("ab\nf", 4, "1:3", "3:7", "0:2,8:9")
    assert ln.cut_text("a", [0])[0] == "" and ln.cut_text(None, []) == (None, 0, "", "", "")


@pytest.mark.parametrize("name", ["op4_line_hash_dedup", "op5_line_window_dedup"])
def test_oracle(spark, name):
    d = "/root/testdata/sf0.001"
    assert compare(se.queries()[name](spark, d), duck(d), se.oracle_sql()[name])[0] == []
