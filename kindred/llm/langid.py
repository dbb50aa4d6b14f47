"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random +-1 vector. A trigram
is the product of its letters' vectors, permuted by their place; a text is
the sum of its trigram vectors. The prototype of a language is the sum of
its training texts' unit vectors. A text gets the language whose prototype
has the largest cosine with it, after the mean of all prototypes is taken
from both (what every language shares tells none apart).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import staged

UNDETERMINED = "und"
GAP = 0
CACHE_ROWS = 1 << 16  # trigram vectors a worker keeps, a byte an entry; others are rebuilt when met


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Code point to itself if it is a letter, else to ``GAP``."""
    return np.fromiter((c if chr(c).isalpha() else GAP for c in range(0x110000)), dtype=np.uint32, count=0x110000)


class Encoder:
    """Texts to vectors; equal for equal ``(dim, seed)`` on every machine."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, tuple] = {}
        self.rows: dict[int, int] = {}
        self.cache = np.empty((0, dim), dtype=np.int8)

    def letter(self, c: int) -> tuple:
        if c not in self.letters:
            v = np.random.default_rng([self.seed, c]).integers(0, 2, self.dim).astype(np.int8) * 2 - 1
            self.letters[c] = (np.roll(v, 2), np.roll(v, 1), v)
        return self.letters[c]

    def trigrams(self, codes: np.ndarray) -> np.ndarray:
        place = [[self.letter(c)[k] for c in (codes >> np.uint64(s) & np.uint64(0x1FFFFF)).tolist()]
                 for k, s in ((0, 42), (1, 21), (2, 0))]
        return np.array(place[0]) * np.array(place[1]) * np.array(place[2])

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        keys = codes.tolist()
        new = [k for k in keys if k not in self.rows]
        if new and len(self.rows) + len(new) <= CACHE_ROWS:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            if len(self.rows) > len(self.cache):
                grown = np.empty((min(CACHE_ROWS, 2 * len(self.rows)), self.dim), dtype=np.int8)
                grown[:len(self.cache)] = self.cache
                self.cache = grown
            self.cache[len(self.rows) - len(new):len(self.rows)] = self.trigrams(np.array(new, dtype=np.uint64))
        elif new:
            return self.trigrams(codes)
        return self.cache[[self.rows[k] for k in keys]]

    def encode(self, text: str | None) -> np.ndarray | None:
        """Sum of the text's trigram vectors; None if it has no letter."""
        return self.counted(text)[0]

    def counted(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """``encode`` and the number of trigrams."""
        if not text:
            return None, 0
        table, total, tail = letter_table(), np.zeros(self.dim), np.array([GAP], dtype=np.uint64)
        found, size = False, 0
        low = text.lower()
        for at in range(0, len(low), 1 << 20):
            points = np.frombuffer(low[at:at + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype="<u4")
            c = np.concatenate([tail, table[points].astype(np.uint64)])
            if at + (1 << 20) >= len(low):
                c = np.concatenate([c, [np.uint64(GAP)]])
            c = c[np.concatenate([[True], (c[1:] != GAP) | (c[:-1] != GAP)])]
            found = found or bool(c.any())
            if len(c) > 2:
                size += len(c) - 2
                codes, n = np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:], return_counts=True)
                for k in range(0, len(codes), 2048):
                    total += np.einsum("i,ij->j", n[k:k + 2048].astype(np.float32), self.vectors(codes[k:k + 2048]).astype(np.float32))
            tail = c[-2:]
        return (total, size) if found else (None, 0)


@lru_cache(maxsize=2)
def encoder(dim: int, seed: int) -> Encoder:
    return Encoder(dim, seed)


def training_rows(docs: DataFrame) -> tuple[list[str], DataFrame]:
    """The labels, and ``lang, text`` of the rows that ``fit`` reads: all that have both."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return sorted(r["lang"] for r in known.select("lang").distinct().collect()), known


def fit(docs: DataFrame, dim: int = 512, seed: int = 7) -> tuple[list[str], np.ndarray]:
    """Labels and their prototypes, from text and non-null ``lang`` of every row.

    The label set is the classifier's class list and small. Prototypes are
    sums per task and label, added up by Spark.
    """
    labels, known = training_rows(docs)
    if not labels:
        return [], np.zeros((0, dim))

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        enc = encoder(dim, seed)
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                v = enc.encode(text.as_py())
                if v is not None and (size := np.linalg.norm(v)) > 0:
                    sums[lang] = sums.get(lang, 0) + v / size
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = staged(known.mapInArrow(bundle, "lang string, v array<double>"), "lang-bundles")
    at = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    proto = np.zeros((len(labels), dim))
    for r in at.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")).collect():
        proto[labels.index(r["lang"])] = [e["x"] for e in r["v"]]
    size = np.linalg.norm(proto, axis=1, keepdims=True)
    return labels, np.round(proto / np.where(size > 0, size, 1), 9)


def classify(v: np.ndarray | None, labels: list[str], proto: np.ndarray) -> tuple[str, float]:
    """Best label and its cosine, cut to 0..1; ties go to the smaller label.
    A prototype without any letters is never chosen."""
    if v is None or not labels or not (size := np.linalg.norm(v)) > 0:
        return UNDETERMINED, 0.0
    mean = proto.mean(axis=0) if len(labels) > 1 else np.zeros(proto.shape[1])
    own, p = v / size - mean, proto - mean
    cos = np.where(proto.any(axis=1), p @ own / np.maximum(np.linalg.norm(p, axis=1) * np.linalg.norm(own), 1e-12), -2)
    best = int(np.argmax(np.round(cos, 9)))
    return (labels[best], float(min(1.0, max(0.0, cos[best])))) if cos[best] > -2 else (UNDETERMINED, 0.0)


def typical(docs: DataFrame, labels: list[str], proto: np.ndarray, seed: int = 7) -> np.ndarray:
    """For each label, the median over its training rows of the dot product
    with the label's prototype for each trigram of the text, the row itself
    taken out of the prototype. -inf for a label of fewer than two rows.

    A trigram's vector has +-1 entries and a prototype length 1, so one that
    the label does not have adds 0 on average, with standard deviation 1; this
    mean does not depend on the text's length. The median is that of all
    rows, counted by value to four places; one number a label goes to the
    driver.
    """
    if not labels:
        return np.zeros(0)
    _, known = training_rows(docs)
    dim = proto.shape[1]

    def score(batches):
        enc = encoder(dim, seed)
        for b in batches:
            out = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                v, n = enc.counted(text.as_py())
                if v is not None and (size := np.linalg.norm(v)) > 0:
                    out.append((lang, float(v @ proto[labels.index(lang)] / size), float(size / n)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), *(
                pa.array([x[k] for x in out], pa.float64()) for k in (1, 2))], ["lang", "cos", "size"])

    rows = staged(known.mapInArrow(score, "lang string, cos double, size double"), "lang-scores")
    # ``whole`` is the length of the sum of unit vectors, as the prototype is its direction
    whole = rows.groupBy("lang").agg(F.sum("cos").alias("whole"), F.count(F.lit(1)).alias("k")).where("k > 1")
    own = F.expr("round(size * (whole * cos - 1) / sqrt(greatest(whole * whole - 2 * whole * cos + 1, 1e-12D)), 4)")
    middle = rows.join(F.broadcast(whole), "lang").groupBy("lang", own.alias("own")).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("lang").agg(F.expr("percentile(own, 0.5D, n)").alias("usual"))
    out = np.full(len(labels), -np.inf)
    for r in middle.collect():
        out[labels.index(r["lang"])] = r["usual"]
    return out


def alike(v: np.ndarray, n: int, proto: np.ndarray, usual: float) -> bool:
    """Whether a text of ``n`` trigrams may be in a prototype's language: its
    mean dot product is at least half the label's usual one, less three
    standard deviations of a text of unknown trigrams (short texts, or ones
    that repeat a few trigrams, tell little and stay)."""
    return bool(v @ proto / n >= usual / 2 - 3 * np.linalg.norm(v) / (n * np.sqrt(len(proto))))


def predict(docs: DataFrame, labels: list[str], proto: np.ndarray, seed: int = 7,
            usual: np.ndarray | None = None) -> DataFrame:
    """``docs`` and, for each row, ``lang_pred`` and ``score`` from its text
    alone: ``und`` and 0 for a null text or one without a letter and, given
    ``usual`` (see ``typical``), for one not ``alike`` its best label. Own
    columns of these names are replaced, others stay."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]).alias("row"), "text")
    dim = proto.shape[1]

    def label(v, n):
        best = classify(v, labels, proto)
        if usual is None or best[0] == UNDETERMINED or alike(v, n, proto[k := labels.index(best[0])], usual[k]):
            return best
        return UNDETERMINED, 0.0

    def run(batches):
        enc = encoder(dim, seed)
        for b in batches:
            out = [label(*enc.counted(t.as_py())) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([x[0] for x in out], pa.string()),
                                              pa.array([x[1] for x in out], pa.float64())], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double") \
        .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(own)], "lang_pred", "score")
