"""License scan against the plain definition, without pruning."""

import __spark_entry__ as se
from kindred.llm import licenses as lic


def brute(text, templates=lic.TEMPLATES, t=0.8):
    out = []
    for a, b in lic.units(text) if text else ():
        own, best = lic.bigrams(text[a:b]), None
        for i, (name, body) in enumerate(templates):
            grams = lic.bigrams(body)
            if own and grams:
                score = 2 * sum((own & grams).values()) / (sum(own.values()) + sum(grams.values()))
                if score >= t and (best is None or score > best[1]):
                    best = (name, score)
        if best:
            out.append((a, b, *best))
    return sorted(out)


def test_units():
    text = "a\nb\n\n c d\n\n\ne"
    assert [text[a:b] for a, b in lic.units(text)] == ["a", "b", "a\nb", " c d", "e", text]
    assert list(lic.units("one")) == [(0, 3)] and list(lic.units(" \n")) == []


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = {r.doc_id: r for r in se.queries()["op10_license_scan"](spark, d).collect()}
    assert set(out) == set(docs) and any(r.n_matches for r in out.values())
    for i, t in docs.items():
        want = brute(t)
        assert out[i].spans == ",".join(f"{n}:{a}:{b}" for a, b, n, _ in want)
        assert out[i].licenses == ",".join(sorted({w[2] for w in want}))


def test_edge_rows(spark):
    mit = lic.TEMPLATES[0][1]
    rows = [(1, None), (2, ""), (3, "MIT"), (4, "x\nreleased under the mit license"), (None, mit), (5, mit.replace("\n", "\n\n")),
            (6, mit + "\n" + "word " * 100_000), (7, "Released under the MIT License. " * 2), (7, "Released under the MIT License. " * 2)]
    df = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, matches int, start string")
    got = sorted((str(r.doc_id), [tuple(m) for m in r.matches]) for r in lic.scan(df).collect())
    assert got == sorted((str(i), brute(t)) for i, t in rows)
    assert [m[1] for m in got if m[0] == "None"][0][0][2] == "MIT"
    assert lic.scan(df.limit(0)).collect() == [] and not any(r.matches for r in lic.scan(df, []).collect())


def brute_runs(text, t=0.8):
    """Best run of whole lines, over all runs and templates."""
    lines, best, all_grams = text.split("\n"), None, [(n, lic.bigrams(b)) for n, b in lic.TEMPLATES]
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            own = lic.bigrams("\n".join(lines[i:j + 1]))
            for name, grams in all_grams:
                score = 2 * sum((own & grams).values()) / max(1, sum(own.values()) + sum(grams.values()))
                if score >= t and (best is None or score > best[0]):
                    best = (score, name, " ".join(lic.WORD.findall("\n".join(lines[i:j + 1]))))
    return best


def test_texts_inside_longer_documents():
    by = dict(reversed(lic.TEMPLATES))
    mit = by["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    assert mit.count("\n\n") == 2
    prose = "\n".join(" ".join(f"w{k}x{i}" for i in range(16)) for k in range(10))
    scan = lic.Scanner(lic.TEMPLATES, 0.8).scan
    for name, body in (("MIT", mit), ("Apache-2.0", by["Apache-2.0"]), ("GPL-3.0", by["GPL-3.0"]), ("BSD-2-Clause", by["BSD-2-Clause"])):
        for gap in ("\n", "\n\n"):
            for text in (prose + gap + body + gap + prose, body + gap + prose, prose + gap + body):
                score, want, words = brute_runs(text)
                a, b, got, dice = max(scan(text), key=lambda m: m[3])
                assert want == name == got and abs(dice - score) < 1e-9
                assert " ".join(lic.WORD.findall(text[a:b])) == words
    twice = prose.join([mit + "\n", "\n" + mit])
    assert [(m[2], m[3]) for m in scan(twice)] == [("MIT", 1.0)] * 2
    assert scan(prose) == [] and [m[:2] for m in scan(mit)] == [(0, len(mit))]
