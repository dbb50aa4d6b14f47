"""Personal data by candidate generation and gradient boosting.

Generators propose overlapping spans: the exact base patterns, loose forms
of them (spelled-out e-mails, other separators, missing prefixes), and
secrets: runs of 16 or more characters that mix letters and digits.
Boosted trees score a candidate from its format and its context, a held-out
part of the documents calibrates the scores and sets one threshold for each
kind, and the loose candidates that reach it are added to the base spans.

The trees are fitted by Spark on all candidates of all documents. Labels are
weak: a base span is personal data, and so is the same value rewritten in a
loose form at the same place; a run that a name such as ``token`` or
``password`` is set to in quotes is a secret. Candidates that none of these
take are not, nor are dates, amounts, versions, plain numbers, paths and bare
digests set at random places.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import boosting
from kindred.llm.common import staged

KINDS = ["email", "ip", "card", "phone"]  # with base patterns
ALL_KINDS = [*KINDS, "secret"]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SAID_AT = re.compile(r"\[at\]|\(at\)| at ", re.I)
SAID_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\[dot\]|\(dot\)| dot |\.)[A-Za-z0-9-]+)+", re.I)
LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[?\.\]? ?[0-9]{1,3}){3}(?![0-9])")
LOOSE_DIGITS = re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,2}[0-9])+")
RUN = re.compile(r"[A-Za-z0-9_+/-]{16,}={0,2}")
NAMED = re.compile(r"(?:token|key|secret|passw(?:or)?d|pwd)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']$", re.I)
WORDS = {  # words near a span that speak for a kind, or for something else
    "email": ("mail", "contact", "write"), "ip": ("ip", "server", "host", "address"),
    "card": ("card", "visa", "credit", "payment", "account"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "api", "auth", "credential"),
    "other": ("id", "order", "token", "key", "version", "page", "isbn", "year")}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def local_start(text: str, at: int, least: int) -> int:
    """Where the run of local characters before ``at`` starts."""
    while at > least and (text[at - 1] in "._%+-" or (text[at - 1].isascii() and text[at - 1].isalnum())):
        at -= 1
    return at


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with the whole run of local characters before it (back to
    the last match at most) and the longest domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = local_start(text, at, end)
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Runs of dotted numbers, four at a time; all parts at most 255."""
    out = []
    for m in CHAIN.finditer(text):
        if m.group().count(".") >= 3:
            at, parts = m.start(), m.group().split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append((at, at + size))
                at += size + 1
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind as in ``KINDS``, then by place."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [("ip", a, b) for a, b in ips(text)]
        out += [("card", m.start(), m.end()) for m in CARD.finditer(text)
                if 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def secret_runs(text: str) -> list[tuple[str, int, int]]:
    """Long runs with a letter and a digit."""
    return [("secret", m.start(), m.end()) for m in RUN.finditer(text)
            if DIGIT.search(m.group()) and any(c.isalpha() for c in m.group())]


def named_secrets(text: str) -> list[tuple[str, int, int]]:
    """Those runs that stand in quotes after a name that speaks for a secret."""
    return [s for s in secret_runs(text) if text[s[2]:s[2] + 1] in ("'", '"') and NAMED.search(text[max(0, s[1] - 24):s[1]])]


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """Loose spans of all generators; they may overlap."""
    if not text:
        return []
    out = []
    for m in SAID_AT.finditer(text):
        start = local_start(text, m.start(), 0)
        tail = SAID_DOMAIN.match(text, m.end())
        if start < m.start() and tail:
            out.append(("email", start, tail.end()))
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in LOOSE_IP.finditer(text)]
        for m in LOOSE_DIGITS.finditer(text):
            n = len(_digits(m.group()))
            out += [("card", m.start(), m.end())] * (13 <= n <= 19) + [("phone", m.start(), m.end())] * (7 <= n <= 15)
        out += secret_runs(text)
    return out


def features(kind: str, before: str, span: str, after: str) -> list[float]:
    """Format of the span, and the characters and words around it. Of a long
    span the format is that of its first 4096 characters."""
    size_all, span = len(span), span[:4096]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    seps = re.findall(r"[^A-Za-z0-9]+", span.strip("+("))
    near = re.findall(r"[^\W\d_]+", before.lower())[-4:]
    prev, nxt = before[-1:], after[:1]
    size = [len(g) for g in groups[:32]] or [0]
    return [
        *(float(kind == k) for k in ALL_KINDS), size_all, len(digits), len(groups), max(size), min(size), size[0], size[-1],
        float(len(set(seps))), float(len(seps)), float("+" in span), float("(" in span), float("-" in span), float("." in span),
        float(" " in span), float("/" in span), float("@" in span or bool(SAID_AT.search(span))),
        float("dot" in span.lower()), float(len(re.split(r"dot|[\].) ]", span)[-1])) if kind == "email" else 0.0,
        float(len(digits) <= 19 and bool(digits) and luhn(digits)), float(all(len(g) < 4 and int(g) < 256 for g in groups)),
        float(digits.startswith("00")), float(digits[:1] in ("3", "4", "5", "6")),
        float(len(set(span))), float(all(c in "0123456789abcdefABCDEF" for c in span)),
        float(len(re.findall(r"[0-9][A-Za-z]|[A-Za-z][0-9]", span))), max(map(len, re.findall(r"[A-Za-z]+", span)), default=0),
        float(bool(re.search(r"[:=][ \t]{0,3}[\"']?$", before))),
        float(prev.isalnum()), float(nxt.isalnum()), float(prev in "\"'=#$€"), float(nxt in "%€$\"'"),
        *(float(any(w.startswith(x) for w in near for x in WORDS[k])) for k in WORDS)]


def _around(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - 40):a], text[a:b], text[b:b + 8]


def _loose_forms(kind: str, s: str, rng: random.Random) -> str:
    """A base value written as the loose generators would find it."""
    if kind == "email":
        local, _, host = s.partition("@")
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), ("(at)", "(dot)"), (" at ", ".")])
        return local + at + host.replace(".", dot)
    if kind == "secret":
        alphabet = rng.choice(["0123456789abcdef", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"])
        value = "".join(rng.choice(alphabet) for _ in range(rng.randint(20, 64)))
        return rng.choice(["", "", "sk-", "pk_"]) + "a1" + value
    if kind == "ip":
        return s.replace(".", rng.choice(["[.]", " . ", ". "]))
    if kind == "card":
        d = _digits(s)
        return rng.choice([".", "/", " - "[:2]]).join(d[k:k + 4] for k in range(0, len(d), 4))
    d = _digits(s)
    area, rest = d[-10:-7] or "555", d[-7:]
    return rng.choice([f"({area}) {rest[:3]}-{rest[3:]}", f"00{d}", f"{area}-{rest[:3]}-{rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}"])


def _loose_setting(left: str, rng: random.Random) -> str:
    """The characters before a named secret, the name set to it in another way."""
    return left.rstrip(" \t:=\"'") + rng.choice([": ", "=", " = ", ": '", '="'])


def _not_personal(rng: random.Random) -> tuple[str, str]:
    """A kind and a value that the kind's generator proposes wrongly."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    return rng.choice([
        ("phone", n(rng.randint(7, 12))), ("phone", f"20{n(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}"),
        ("phone", f"{n(3)} {n(3)} {n(3)}"), ("phone", f"{n(4)}-{n(4)}"), ("card", n(rng.randint(13, 15))), ("phone", f"{n(2)}.{n(6)}"),
        ("ip", f"{rng.randint(256, 999)}.{n(3)}.{n(1)}.{n(2)}"), ("ip", f"{n(1)}. {n(1)}. {n(1)}. {n(1)}"),
        ("secret", f"{rng.choice(['section', 'release', 'chapter'])}-{n(2)}/{rng.choice(['summary', 'notes', 'tables'])}-{n(3)}"),
        ("secret", f"{n(4)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}T{n(2)}-{n(2)}-{n(2)}"),
        ("secret", "a0" + "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([30, 38, 62])))),
        ("email", f"look at {rng.choice(['the', 'this', 'page'])}.net"), ("email", "arrive at noon.then")])


def training_rows(text: str, key: str) -> list[tuple[list[float], float, int, str]]:
    """``(features, label, held out, kind)`` of all candidates of one document."""
    rng = random.Random(zlib.crc32(key.encode("utf-8", "surrogatepass")))
    base, named = base_spans(text), named_secrets(text)
    taken = np.zeros(len(text), dtype=bool)
    for _, a, b in base:
        taken[a:b] = True
    rows = []
    for kind, a, b in base + named:
        left, span, right = _around(text, a, b)
        loose = _loose_setting(left, rng) if kind == "secret" else left
        for before, s in ((left, span), (loose, _loose_forms(kind, span, rng))):
            rows.append((features(kind, before, s, right), 1.0, kind))
    known = set(named)
    for kind, a, b in candidates(text):
        if (kind, a, b) not in known and not taken[a:b].any():
            rows.append((features(kind, *_around(text, a, b)), 0.0, kind))
    gap = text.find(" ", rng.randrange(len(text)))
    if gap >= 0:
        kind, s = _not_personal(rng)
        rows.append((features(kind, text[max(0, gap - 39):gap + 1], s, text[gap:gap + 8]), 0.0, kind))
    held = int(rng.random() < 0.25)
    return [(f, y, held, k) for f, y, k in rows]


def fit(docs: DataFrame, precision: float = 0.98) -> tuple[boosting.Trees, dict[str, float]] | None:
    """Calibrated trees and a threshold for each kind that reaches
    ``precision`` on the held-out rows; None if the rows cannot decide.

    Every candidate of every document is read. Equal rows are stored once,
    with their number; Spark fits the trees on those that are not held out
    and scores the others, of which the driver gets counts by kind, label and
    rounded score."""
    def run(batches):
        for b in batches:
            rows = []
            for t in b.column("text"):
                rows += training_rows(s := t.as_py(), s[:200])
                if len(rows) >= 5000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.float64()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.string())],
            ["x", "y", "held", "kind"])

    made = docs.where("text <> ''").select("text").mapInArrow(run, "x array<double>, y double, held int, kind string")
    made = staged(made.groupBy("x", "y", "held", "kind").agg(F.count(F.lit(1)).cast("double").alias("n"))
                  .sortWithinPartitions("x", "y", "held", "kind"), "pii-rows")
    if made.select("held", "y").distinct().count() < 4:
        return None
    trees = boosting.fit_rows(made.where("held = 0"))

    def score(batches):
        for b in batches:
            if b.num_rows:
                s = trees.raw(np.stack([np.asarray(x) for x in b.column("x").to_pylist()]))
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("y"), b.column("n"), pa.array(s)], ["kind", "y", "n", "s"])

    rows = made.where("held = 1").select("x", "kind", "y", "n").mapInArrow(score, "kind string, y double, n double, s double") \
        .groupBy("kind", "s", "y").agg(F.sum("n").alias("n")).orderBy("kind", "s", "y").toPandas()
    s, y, n = (rows[c].to_numpy() for c in "syn")
    model = boosting.calibrate_sums(trees, s, y, n)
    p, limits = np.round(model.calibrated(s), 6), {}
    for kind in ALL_KINDS:
        own = rows["kind"].to_numpy() == kind
        order = np.argsort(-p[own], kind="stable")
        pk, yk, nk = p[own][order], y[own][order], n[own][order]
        right = np.cumsum(yk * nk) / np.cumsum(nk)
        ends = np.append(np.diff(pk) != 0, True) if len(order) else np.zeros(0, dtype=bool)
        good = np.flatnonzero(ends & (right >= precision) & (np.cumsum(nk) >= 10))
        if len(good):
            limits[kind] = max(0.5, float(pk[good[-1]]))
    return model, limits


def added_spans(text: str, base: list[tuple[str, int, int]], model, limits) -> list[tuple[str, int, int]]:
    """Loose candidates that reach their kind's threshold and touch no base
    span; of two that overlap, the one with the higher score."""
    cands = [c for c in candidates(text) if c[0] in limits]
    if not cands:
        return []
    p = np.round(model.probability(np.array([features(k, *_around(text, a, b)) for k, a, b in cands])), 6)
    taken = np.zeros(len(text), dtype=bool)
    for _, a, b in base:
        taken[a:b] = True
    out = []
    for k in sorted(range(len(cands)), key=lambda k: (-p[k], cands[k][1], cands[k][2], cands[k][0])):
        kind, a, b = cands[k]
        if p[k] >= limits[kind] and not taken[a:b].any():
            taken[a:b] = True
            out.append(cands[k])
    return out


def find(docs: DataFrame, fitted: tuple | None) -> DataFrame:
    """``doc_id, base, spans`` for each row of ``docs(doc_id, text)``: arrays
    of ``kind, start, end`` (code points, end exclusive) by kind as in
    ``ALL_KINDS``, then place. ``base`` are the base patterns' spans, ``spans``
    those and the added ones (none without ``fitted``). Null and empty texts
    have none. Other columns are ignored; repeated rows each give a row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    model, limits = fitted or (None, {})
    rank = {k: i for i, k in enumerate(ALL_KINDS)}

    def run(batches):
        for b in batches:
            base, every = [], []
            for t in b.column("text"):
                text = t.as_py()
                own = base_spans(text)
                both = own + (added_spans(text, own, model, limits) if text and limits else [])
                base.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                every.append([dict(zip(("kind", "start", "end"), s)) for s in sorted(both, key=lambda s: (rank[s[0]], *s[1:]))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(base, shape), pa.array(every, shape)],
                                             ["doc_id", "base", "spans"])

    row = "array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base {row}, spans {row}")


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span, overlaps merged, as ``[KIND]``."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
