"""Cross-tokenizer alignment against a plain Python count, the tokenizer
libraries themselves, and planted texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as se
from kindred.llm import alignment as al

FILE_A, FILE_B = f"{al.FOLDER}/byte_bpe_50k.json", f"{al.FOLDER}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(FILE_A)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=FILE_B)


def aligned(text, tools):
    """Groups of one text, from the libraries' own pieces."""
    t, p = tools
    whole = (" " + text).encode() if text else b""
    if not whole:
        return []
    decode = al.byte_decoder()
    a = [(i, bytes(decode[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode())
         for i in p.encode(text)]
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    out, i, j, la, lb = [], 0, 0, 0, 0
    ga, gb = [], []
    while i < len(a) or j < len(b):
        if la <= lb:
            ga.append(a[i][0])
            la += len(a[i][1])
            i += 1
        else:
            gb.append(b[j][0])
            lb += len(b[j][1])
            j += 1
        if la == lb and ga and gb:
            out.append((ga, gb))
            ga, gb = [], []
    return out


def brute(rows, tools):
    groups = [aligned(t, tools) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(k for c in links for k in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (i, _), g, c in zip(rows, groups, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((str(i), sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for k, n in c.items() if held[k] == most[k[0]]), sum(n * held[k] for k, n in c.items()),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out)


def got(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r.doc_id), *(r[n] for n in names)) for r in df.collect())


def test_query_matches_brute_force(spark, tools):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(se.queries()["op12_tokenizer_alignment"](spark, d)) == brute(rows, tools)


EDGE = [(1, None), (2, ""), (3, " "), (4, "a"), (5, "Hello  world\n\nüber <|endoftext|> <s> </s> <unk> \x00\x7f tab\t."),
        (6, "日本語のテキスト 中文 العربية 👩‍👩‍👧 é  　x"), (7, "a" * 30_000), (8, " " * 5_000 + "x"), (9, "\n" * 3000),
        (10, "ab" * 20_000), (11, "é" * 9_000), (12, "▁ literal ▁▁ block"), (13, "<0x41> and <0xFF>"), (14, "same words"), (14, "same words"),
        (None, "same words"), (-5, "word " * 20_000), (15, "﻿bom \r\n line"), (16, "ﬁ ① Ａ")]


def test_edge_rows(spark, tools):
    df = spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("block", F.lit("x")).withColumn("place", F.lit(1)) \
        .withColumn("a", F.lit(2)).withColumn("planes", F.lit(3))
    assert got(al.align(df)) == brute(EDGE, tools)
    assert al.align(df.limit(0)).collect() == []


def test_many_small_blocks(spark, tools, monkeypatch):
    """Counts run across blocks and tasks. (Block sizes are read on the
    workers, so the parts are made by hand.)"""
    monkeypatch.setattr(al, "BLOCK_DOCS", 2)
    assert al.Block(0, 10).full() is False
    rows = [(i, f"the quick fox number {i % 7} and the the the lazy dog {'very ' * (i % 5)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert got(al.align(df)) == brute(rows, tools)


def test_wide_groups_and_pieces(monkeypatch):
    """Groups counted by id first, and links in pieces, give the same pairs."""
    side = al.Encoder([b"x"] * 50, None)
    one = al.Aligner(side, side)
    rng = np.random.default_rng(0)
    nx, ny = rng.integers(1, 30, 40), rng.integers(1, 30, 40)
    x, y, doc = rng.integers(0, 50, nx.sum()), rng.integers(0, 50, ny.sum()), np.sort(rng.integers(0, 4, 40))
    want = one.pairs(x, y, nx, ny, doc)
    for wide, piece in ((0, 1 << 22), (0, 7), (1 << 30, 100)):
        monkeypatch.setattr(al, "WIDE", wide)
        monkeypatch.setattr(al, "PIECE", piece)
        assert all((p == q).all() for p, q in zip(one.pairs(x, y, nx, ny, doc), want))


def test_engine_gives_the_files_tokens(tools):
    """The same ids as the file's own library, on every character of the two
    first planes beside letters, digits, marks and spaces."""
    a = al.byte_level(FILE_A)
    assert a.bytes[220] == b" "
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 16):
        text = "".join(f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}! {chr(c)} {chr(c)}{chr(c)}  " for c in points[at:at + 16])
        if at % 512 == 0 or at < 0x3000:
            assert a.encode([text])[0] == tools[0].encode(" " + text, add_special_tokens=False).ids


def test_bitmaps():
    rng = np.random.default_rng(2)
    for n, top in ((1, 1), (1, 60_000), (40, 60_000), (3000, 4000), (4000, 4000)):
        places = np.sort(rng.choice(top, n, replace=False))
        packed = al.pack(places)
        assert (al.unpack(packed) == places).all() and al.bitmap_count(packed) == n
        assert len(packed) <= 1 + min(2 * n, top // 8 + 1)
        many = rng.integers(1, 300, n)
        out = np.zeros(top, dtype=np.int64)
        maps = al.planes(places, many - 1)
        al.add_weights(maps, out, 3)
        assert (out[places] == 3 * many).all() and out.sum() == 3 * al.link_count(maps)
