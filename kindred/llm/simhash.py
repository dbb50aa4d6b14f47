"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check.

Exact copies collapse to one fingerprint first. Each distinct fingerprint is
split into ``blocks`` bit blocks; two that differ in at most ``max_bits`` bits
agree on at least ``blocks - max_bits`` of them, so every choice of that many
blocks is a bucket key and each close pair meets in some bucket. Buckets of
one fingerprint are dropped, large buckets are cut into chunk pairs dealt to
different tasks, and each bucket yields a star per linked group and not all
pairs. Connected components of the stars give the classes.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import components, staged

SEED = 42


def simhash64(data: bytes | None, words: int = 3) -> int:
    """Unsigned fingerprint of one UTF-8 text (see ``fingerprints``)."""
    w = data.lower().split() if data else []  # bytes: ASCII case and ASCII white space only
    if not w:
        return 0
    shingles = list(map(b" ".join, zip(*(w[i:] for i in range(words))))) if len(w) >= words else [b" ".join(w)]
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):
        part = h[at:at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` and ``fp`` for each row of ``docs``: 64-bit SimHash
    of ``text``, signed.

    Text is lower-cased in A-Z and cut at ASCII white space into words;
    features are the ``words``-word shingles with repeats, joined by one
    space (fewer words: the whole sequence), hashed with XXH64 seed 42. A
    bit is 1 if it is set in over half the hashes. A null, empty or blank
    text has fingerprint 0. Rows with equal ``doc_id`` each give a row.
    """
    rows = docs.select(*carry, F.col("text").cast("binary").alias("_text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches):
        for b in batches:
            fp = [simhash64(x.as_py(), words) for x in b.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in carry] + [pa.array(np.array(fp, dtype=np.uint64).view(np.int64))], [*carry, "fp"])

    return rows.mapInArrow(run, f"{kinds}, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Bit masks (signed) of every choice of ``blocks - max_bits`` blocks."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(one, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def stars(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span each group of ``fps`` connected by steps of at most
    ``max_bits`` bits: every member with the group's smallest value."""
    left = np.unique(np.asarray(fps, dtype=np.int64))
    out = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        stack = [root]
        while stack and len(left):
            near = np.bitwise_count((left ^ stack.pop()).view(np.uint64)) <= max_bits  # signed: would count the absolute value
            found, left = left[near], left[~near]
            stack.extend(found)
            out.extend((int(root), int(x)) for x in found)
    return out


def links(fps: DataFrame, max_bits: int = 3, blocks: int = 5, bucket_rows: int = 4096) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints of ``fps(fp)``
    (distinct) which steps of at most ``max_bits`` differing bits connect.

    A bucket with more than ``bucket_rows`` fingerprints is dealt as pairs
    of hashed chunks, so no task holds it whole and no pair is missed.
    """
    masks = block_masks(blocks, max_bits)
    keys = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                      .alias("k", "key"))
    full = staged(keys.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    chunks = F.ceil(F.col("n") / bucket_rows).cast("int")
    rows = keys.join(full, ["k", "key"]).withColumn("q", chunks) \
        .withColumn("c", F.expr("cast(pmod(xxhash64(fp), q) AS int)")) \
        .withColumn("o", F.explode(F.expr("sequence(0, q - 1)"))) \
        .select("fp", "k", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
    met = rows.groupBy("k", "key", "i", "j").agg(F.collect_list("fp").alias("fps"))

    def run(batches):
        for b in batches:
            found = [p for x in b.column("fps") for p in stars(x.values.to_numpy(), max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                              pa.array([p[1] for p in found], pa.int64())], ["a", "b"])

    return met.select("fps").mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, words: int, max_bits: int, blocks: int, carry: tuple[str, ...]) -> DataFrame:
    """``near_duplicates`` with the component's smallest fingerprint, ``root``,
    which tells components apart where ids are null or repeated."""
    rows = staged(fingerprints(docs, words, carry), "simhash")
    groups = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-groups")
    roots = components(links(groups.select("fp"), max_bits, blocks))
    member = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = staged(member, "simhash-members")
    least = staged(member.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-components")
    names = staged(member.join(least, "root").select("fp", "root", "component_id"), "simhash-names")
    return rows.join(names, "fp").select(*carry, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, blocks: int = 5,
                    carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry``, ``fp`` and ``component_id`` for each row of
    ``docs``: the smallest ``doc_id`` reachable over fingerprints that differ
    in at most ``max_bits`` bits. Null ids are never a component's id unless
    the whole component has none. Empty input gives an empty result; other
    columns of ``docs`` are ignored.
    """
    return classes(docs, words, max_bits, blocks, carry).select(*carry, "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest
    ``doc_id``, a null id counting as the largest; of several rows with that
    id the one whose text has the smallest hash, repeated rows once."""
    d = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long")
    keyed = docs.select(d.alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    found = classes(keyed, words, max_bits, blocks, ("doc_id", "h"))
    keep = staged(found.where("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("h").alias("h"))
                  .select(F.col("doc_id").alias("_simhash_d"), F.col("h").alias("_simhash_h")), "simhash-keep")
    met = docs.withColumn("_simhash_d", d).withColumn("_simhash_h", F.xxhash64("text")).join(keep, ["_simhash_d", "_simhash_h"], "left_semi")
    first = Window.partitionBy("_simhash_d", "_simhash_h").orderBy("_simhash_d")
    return met.withColumn("_simhash_n", F.row_number().over(first)).where("_simhash_n = 1").drop("_simhash_d", "_simhash_h", "_simhash_n")
