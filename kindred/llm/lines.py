"""Repeated units across a corpus: lines joined to a least number of words,
and windows of three lines.

Both operators reduce a document to digests of its units, find the earliest
occurrence of each digest by a partially aggregated minimum, join that back
to the stored occurrences and cut the later ones out of the texts. Only
digests and positions are grouped; a text is moved once, to be cut.

Occurrences are ranked by ``(doc_id, text hash, line)``, a null ``doc_id``
last; ids may be of any type that has an order. Rows that share ``doc_id`` and
text are one document given several times and are cut alike; rows that share
only ``doc_id``, null ids included, are documents of their own.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kindred.llm.common import staged

def keys() -> list:
    return [F.col("doc_id").alias("d"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("h")]


def digest(data: str) -> bytes:
    return hashlib.blake2b(data.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def normal_line(line: str) -> str:
    """A-Z in lower case, words (cut at ASCII white space) joined by one space."""
    return b" ".join(line.encode("utf-8", "surrogatepass").lower().split()).decode("utf-8", "surrogatepass")


def line_units(text: str, least_words: int) -> list[tuple[int, bytes, int]]:
    """``(line, digest, lines)`` of the unit that starts at each line with a
    word: that line and those after it until there are ``least_words`` words.
    Where the text ends before that, the last unit reaches back instead."""
    lines = [normal_line(x) for x in text.split("\n")]
    words = [x.count(" ") + 1 if x else 0 for x in lines]
    out = []
    end, held = 0, 0
    for start, own in enumerate(words):
        while end < len(lines) and held < least_words:
            held += words[end]
            end += 1
        if own:
            if held < least_words:
                while start and held < least_words:
                    start -= 1
                    held += words[start]
                out.append((start, digest("\n".join(filter(None, lines[start:end]))), end - start))
                break
            out.append((start, digest("\n".join(filter(None, lines[start:end]))), end - start))
        held -= own
    return out


def window_units(text: str, size: int) -> list[tuple[int, bytes, int]]:
    """``(line, digest, size)`` of each run of ``size`` consecutive lines,
    compared without white space at their ends."""
    lines = [x.strip(" \t\r") for x in text.split("\n")]
    return [(n, digest("\n".join(lines[n:n + size])), size) for n in range(len(lines) - size + 1)
            if any(lines[n:n + size])]


def occurrences(docs: DataFrame, units) -> DataFrame:
    """``units(text)`` of every document as rows ``d, h, line, digest, size``."""
    def run(batches):
        for b in batches:
            cols = ([], [], [], [], [])
            for d, h, t in zip(b.column("d").to_pylist(), b.column("h").to_pylist(), b.column("text")):
                t = t.as_py()
                for unit in units(t) if t else ():
                    for c, v in zip(cols, (d, h, *unit)):
                        c.append(v)
                if len(cols[0]) >= 10_000:
                    yield _batch(cols, id_type)
                    cols = ([], [], [], [], [])
            yield _batch(cols, id_type)

    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return docs.select(*keys(), "text").mapInArrow(run, f"d {kind.simpleString()}, h long, line int, digest binary, size int")


def _batch(cols, id_type):
    kinds = (id_type, pa.int64(), pa.int32(), pa.binary(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["d", "h", "line", "digest", "size"])


def later_lines(occ: DataFrame) -> DataFrame:
    """``(d, h, lines)``: sorted line numbers covered by an occurrence that is
    later than, and does not overlap, the first one of its digest."""
    occ = staged(occ, "unit-occurrences")
    at = F.struct(F.col("d").isNull().alias("z"), "d", "h", "line")
    first = occ.groupBy("digest").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo <> hi") \
        .select("digest", F.col("lo.d").alias("fd"), F.col("lo.h").alias("fh"), F.col("lo.line").alias("fl"))
    return occ.join(staged(first, "unit-firsts"), "digest").where("NOT d <=> fd OR h <> fh OR line >= fl + size") \
        .select("d", "h", F.explode(F.expr("sequence(line, line + size - 1)")).alias("line")) \
        .groupBy("d", "h").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def spans(lines: list[int]) -> list[tuple[int, int]]:
    """Sorted line numbers as runs, end exclusive."""
    out = []
    for n in lines:
        if out and out[-1][1] == n:
            out[-1] = (out[-1][0], n + 1)
        else:
            out.append((n, n + 1))
    return out


def cut_text(text: str | None, lines: list[int]) -> tuple:
    """``(kept text, number of lines, removed line runs, removed character
    runs, kept character runs)``, runs as ``start:end`` joined by commas, in
    code points of the original; the line breaks belong to neither side."""
    if text is None:
        return None, 0, "", "", ""
    parts, gone = text.split("\n"), set(lines)
    starts, at = [], 0
    for x in parts:
        starts.append(at)
        at += len(x) + 1
    runs = spans(sorted(gone))
    kept = [n for n in range(len(parts)) if n not in gone]

    def chars(rs):
        return ",".join(f"{starts[a]}:{starts[b - 1] + len(parts[b - 1])}" for a, b in rs)

    return ("\n".join(parts[n] for n in kept), len(parts), ",".join(f"{a}:{b}" for a, b in runs),
            chars(runs), chars(spans(kept)))


CUT = "kept string, n_lines long, n_removed long, removed_lines string, removed_spans string, kept_spans string"


def cut(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``CUT`` after its own."""
    base = docs.schema
    own = [f"_c{i}" for i in range(len(base))]
    rows = docs.select(*keys(), F.struct(*[F.col(f"`{f.name}`").alias(o) for f, o in zip(base, own)]).alias("row"),
                       "text").join(removed.select(F.col("d").alias("rd"), F.col("h").alias("rh"), "lines"),
                                    F.col("d").eqNullSafe(F.col("rd")) & (F.col("h") == F.col("rh")), "left").select("row", "text", "lines")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, {CUT}"

    def run(batches):
        for b in batches:
            out = [(*cut_text(t.as_py(), x), len(x))
                   for t, x in zip(b.column("text"), (v or [] for v in b.column("lines").to_pylist()))]
            kept, n, lines, gone, left, k = zip(*out) if out else ((),) * 6
            s, i = pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(kept, s), pa.array(n, i), pa.array(k, i), pa.array(lines, s),
                 pa.array(gone, s), pa.array(left, s)],
                ["row", "kept", "n_lines", "n_removed", "removed_lines", "removed_spans", "kept_spans"])

    cut_cols = ["kept", "n_lines", "n_removed", "removed_lines", "removed_spans", "kept_spans"]
    return rows.mapInArrow(run, schema).select(
        *[F.col(f"row.{o}").alias(f.name) for f, o in zip(base, own) if f.name not in cut_cols], *cut_cols)


def window_dedup(docs: DataFrame, size: int = 3) -> DataFrame:
    """Line dedup by overlapping windows of ``size`` consecutive lines.

    Every window that repeats anywhere in ``docs(doc_id, text)`` keeps its
    first occurrence; the lines covered by later ones are merged and
    removed. An occurrence that overlaps the first one in the same document
    is part of it and stays. Windows of blank lines only are not compared.
    Texts of fewer than ``size`` lines, empty and null texts stay as they
    are. Input columns stay, but for those named as in ``CUT``.
    """
    return cut(docs, later_lines(occurrences(docs, lambda t: window_units(t, size))))


def unit_dedup(docs: DataFrame, least_words: int = 15) -> DataFrame:
    """Substring dedup by line hashing.

    Every line with a word starts a unit: itself if it has ``least_words``
    words, else with the lines after it until they have as many together (at
    the end of a text, with those before it). So every line stands in a unit,
    and a short stock line is none alone. Units are compared in lower case
    (A-Z) with ASCII white space as one space, blank lines left out. The
    earliest occurrence of a unit stays, lines covered by others go; offsets
    of kept and removed runs refer to the original text. An occurrence that
    overlaps the first one in the same document stays. Empty, blank and null
    texts stay as they are. Input columns stay, but for those named as in
    ``CUT``.
    """
    return cut(docs, later_lines(occurrences(docs, lambda t: line_units(t, least_words))))
