"""MinHash near-duplicates with SuperMinHash signatures.

Every shingle of a document has a random permutation of the ``m`` slots and a
random fraction for each rank. Slot ``k`` of the signature is the least ``rank
+ fraction`` any shingle gives it. Ranks are dealt level by level to all
shingles of a batch of documents at once; a document stops at the first level
at which all its slots are filled, as later ranks cannot be smaller. Within a
document the slots are correlated such that the share of equal slots varies
less than with independent hashes.

Equal sets collapse to one digest first. Bands of the signature give buckets;
rows of a bucket are compared by signature, which leaves coarse groups; within
those, links are confirmed on the full shingle sets. Classes are the connected
components of confirmed links. Large buckets and groups are cut into chunk
pairs for different tasks and give spanning stars, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import components, staged

GOLDEN = 0x9E3779B97F4A7C15
LOW32 = np.uint64(0xFFFFFFFF)
S32 = np.uint64(32)
EMPTY = np.iinfo(np.uint64).max
CELLS = 1 << 22          # permutation entries held at a time
SLOTS = 1 << 20          # hash slots of the filter before a join


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser of each number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(data: bytes | None, words: int = 2, known: dict | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of a UTF-8
    text: A-Z lower-cased, cut at ASCII white space; fewer words are one
    shingle, none give the empty set. ``known`` remembers word hashes."""
    w = data.lower().split() if data else []  # bytes: ASCII case and ASCII white space only
    if not w:
        return np.zeros(0, dtype=np.uint64)
    known = {} if known is None else known
    for x in set(w).difference(known):
        known[x] = xxhash.xxh3_64_intdigest(x)
    h = np.fromiter(map(known.__getitem__, w), dtype=np.uint64, count=len(w))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(GOLDEN) + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def signatures(sets: list[np.ndarray], m: int = 128) -> np.ndarray:
    """SuperMinHash of each non-empty set: ``rank << 32 | fraction`` by slot."""
    sig = np.full((len(sets), m), EMPTY, dtype=np.uint64)
    limit = max(1, CELLS // m)
    rest = []
    for d, s in enumerate(sets):
        if len(s) > limit:  # very long: most slots fill at the first ranks, so one part after the other
            for at in range(0, len(s), limit):
                _deal(sig, [(d, s[at:at + limit])], m)
        else:
            rest.append((d, s))
    group, n = [], 0
    for d, s in rest:
        if n + len(s) > limit:
            _deal(sig, group, m)
            group, n = [], 0
        group.append((d, s))
        n += len(s)
    _deal(sig, group, m)
    return sig


def _deal(sig: np.ndarray, group: list[tuple[int, np.ndarray]], m: int) -> None:
    """Lowers ``sig`` by the ranks of the shingles in ``group``: level ``j``
    gives every shingle the ``j``-th entry of its own shuffle. A document goes
    on until all its slots hold a rank of at most ``j``."""
    group = [(d, s) for d, s in group if len(s)]
    if not group:
        return
    h = np.concatenate([s for _, s in group])
    doc = np.repeat(np.array([d for d, _ in group]), [len(s) for _, s in group])
    perm = np.tile(np.arange(m, dtype=np.uint16), (len(h), 1))
    row = np.arange(len(h))
    for j in range(m):
        draw = mix64(h + np.uint64((j + 1) * GOLDEN & (1 << 64) - 1))
        at = j + ((draw & LOW32) * np.uint64(m - j) >> S32).astype(np.int64)  # the shuffle's swap of places j and at
        slot = perm[row, at]
        perm[row, at] = perm[row, j]
        value = np.uint64(j) << S32 | draw >> S32
        lower = value < sig[doc, slot]
        np.minimum.at(sig, (doc[lower], slot[lower]), value[lower])
        if j + 1 == m:
            break
        docs = np.unique(doc)
        open_ = docs[sig[docs].max(axis=1) >= np.uint64(j + 1) << S32]
        if not len(open_):
            break
        if len(open_) < len(docs):
            stay = np.isin(doc, open_)
            h, doc, perm = h[stay], doc[stay], perm[stay]
            row = np.arange(len(h))


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` slots, the band's number mixed in."""
    bands = sig.shape[1] // rows
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for i in range(rows):
        key = mix64(key * np.uint64(GOLDEN) + sig[:, i:bands * rows:rows])
    return key.view(np.int64)


def digest(s: np.ndarray) -> int:
    """Signed 64-bit digest of a shingle set."""
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 7)).astype(np.int64))


def sketch(docs: DataFrame, words: int, m: int, rows: int) -> DataFrame:
    """``doc_id``, ``th`` (text hash), ``n`` (shingles), ``g`` (digest of the
    set), ``sig`` (low byte of every slot) and ``keys`` (bands) by document;
    without shingles the last three are null."""
    source = docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("b"))

    def run(batches):
        known: dict[bytes, int] = {}
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                if len(known) > 1 << 19:
                    known.clear()
                sets = [shingle_set(x.as_py(), words, known) for x in part.column("b")]
                sig = signatures(sets, m)
                has = [len(s) > 0 for s in sets]
                keys, low = band_keys(sig, rows), sig.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if y else None for s, y in zip(sets, has)], pa.int64()),
                    pa.array([low[i].tobytes() if y else None for i, y in enumerate(has)], pa.binary()),
                    pa.array([keys[i] if y else None for i, y in enumerate(has)], pa.list_(pa.int64()))],
                    ["doc_id", "th", "n", "g", "sig", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, th long, n long, g long, sig binary, keys array<long>")


def chunked(members: DataFrame, group: list[str], parts: DataFrame) -> DataFrame:
    """``members(*group, g)`` dealt to the chunk pairs ``i <= j`` of their
    group; ``parts(*group, q)`` has the number of chunks."""
    return members.join(parts, group) \
        .withColumn("c", F.expr("cast(pmod(xxhash64(g, 3), q) AS int)")) \
        .withColumn("o", F.explode(F.expr("sequence(0, q - 1)"))) \
        .select(*group, "g", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` may be one of ``wanted``: those whose hash slot
    is taken. The set of slots is bounded and broadcast; it keeps rows that
    meet nothing out of a shuffle, and the join that follows is exact."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    taken = staged(wanted.select(slot.alias("_slot")).distinct(), "minhash-slots")
    return rows.join(F.broadcast(taken), slot == F.col("_slot"), "left_semi")


def explore(ids: np.ndarray, near) -> list[tuple[int, int]]:
    """Stars that span what steps of ``near(one, others) -> mask`` connect;
    the arguments are places in ``ids``."""
    left = np.arange(len(ids))
    out = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        stack = [root]
        while stack and len(left):
            met = near(stack.pop(), left)
            found, left = left[met], left[~met]
            stack.extend(found)
            out.extend((int(ids[root]), int(ids[x])) for x in found)
    return out


def edges_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                       pa.array([p[1] for p in found], pa.int64())], ["a", "b"])


def coarse_links(sigs: DataFrame, share: float, bucket_rows: int) -> DataFrame:
    """Edges ``(a, b)`` over digests of ``sigs(g, sig, keys)`` (distinct) that
    span what equal bands and ``share`` of equal signature bytes connect."""
    keys = sigs.select("g", F.explode("keys").alias("key"))
    # Bands with the same members make one bucket: count, sum and xor of member hashes tell.
    h = F.xxhash64("g")
    full = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")) \
        .where("n > 1").groupBy("n", "s", "x").agg(F.min("key").alias("key")) \
        .select("key", F.ceil(F.col("n") / bucket_rows).cast("int").alias("q"))
    full = staged(full, "minhash-buckets")
    met = staged(chunked(likely(keys, "key", full), ["key"], full), "minhash-met")
    lists = met.join(sigs.select("g", "sig"), "g").groupBy("key", "i", "j") \
        .agg(F.collect_list(F.struct("g", "sig")).alias("rows"))

    def run(batches):
        for b in batches:
            found = []
            for x in b.column("rows"):
                ids = x.values.field("g").to_numpy()
                sig = np.frombuffer(b"".join(x.values.field("sig").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
                first = np.unique(ids, return_index=True)[1]
                ids, sig = ids[first], sig[first]
                least = share * sig.shape[1]
                found += explore(ids, lambda one, others: (sig[others] == sig[one]).sum(axis=1) >= least)
            yield edges_batch(found)

    return lists.select("rows").mapInArrow(run, "a long, b long").distinct()


def confirmed_links(sets: DataFrame, threshold: int, chunk_bytes: int) -> DataFrame:
    """Edges ``(a, b)`` that span what pairs with ``100 * intersection >=
    threshold * union`` connect inside each ``root`` of ``sets(g, root, s)``;
    ``s`` is the binary full set."""
    parts = staged(sets.groupBy("root").agg(F.sum(F.octet_length("s") + 64).alias("b"))
                   .select("root", F.ceil(F.col("b") / chunk_bytes).cast("int").alias("q")), "minhash-parts")
    met = chunked(sets.select("root", "g"), ["root"], parts)
    lists = met.join(sets.select("g", "s"), "g").groupBy("root", "i", "j") \
        .agg(F.collect_list(F.struct("g", "s")).alias("rows"))

    def run(batches):
        for b in batches:
            found = []
            for x in b.column("rows"):
                ids = x.values.field("g").to_numpy()
                first = np.unique(ids, return_index=True)[1]
                full = [np.frombuffer(x.values.field("s")[int(i)].as_py(), dtype=np.uint64) for i in first]
                found += explore(ids[first], FullSets(full, threshold).near)
            yield edges_batch(found)

    return lists.select("rows").mapInArrow(run, "a long, b long").distinct()


class FullSets:
    """Exact comparison of one set with many."""

    def __init__(self, sets: list[np.ndarray], threshold: int):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.flat = np.concatenate(sets)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.threshold = threshold

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        n, size = self.size[one], self.size[others]
        out = 100 * np.minimum(n, size) >= self.threshold * np.maximum(n, size)
        live = others[out]
        if len(live):
            size = self.size[live]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(self.start[live] - (ends - size), size)
            mine = self.flat[self.start[one]:self.start[one] + n]
            theirs = self.flat[at]
            hit = mine[np.minimum(np.searchsorted(mine, theirs), n - 1)] == theirs
            both = np.add.reduceat(hit, ends - size, dtype=np.int64)
            out[out] = 100 * both >= self.threshold * (n + size - both)
        return out


def near_duplicates(docs: DataFrame, words: int = 2, threshold: int = 80, m: int = 128, band_rows: int = 4,
                    coarse_share: float = 0.6, bucket_rows: int = 4096, chunk_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents link where ``100 * intersection >= threshold * union`` of their
    distinct ``words``-word shingles, confirmed on the full sets (of 64-bit
    hashes). ``component_id`` is the smallest ``doc_id`` reachable.

    What may be missed: a linked pair that shares no band (with 32 bands of 4
    rows at a similarity of 0.8 one in 2e7) or agrees in less than
    ``coarse_share`` of the signature (0.6: 5 standard deviations off). Before
    that, equal sets have met by digest.

    A null, empty or blank text has no shingle and is a class of its own. Rows
    of one ``doc_id`` are documents of their own, so are repeated rows. A null
    ``doc_id`` is no class's id unless the whole class has none, and then
    ``component_id`` is null; such rows are kept. Other columns of ``docs``
    are ignored; empty input gives no row.
    """
    rows = staged(sketch(docs, words, m, band_rows), "minhash-sketch")
    sets = rows.where("g IS NOT NULL").groupBy("g").agg(
        F.min("doc_id").alias("first"), F.min("sig").alias("sig"), F.min("keys").alias("keys"), F.min(F.struct("doc_id", "th")).alias("at"))
    sets = staged(sets, "minhash-sets")
    coarse = components(coarse_links(sets, coarse_share, bucket_rows))
    # The texts of coarse groups are read again: one row of each digest.
    picked = sets.join(coarse.withColumnRenamed("node", "g"), "g") \
        .select("g", "root", F.col("at.doc_id").alias("d"), F.col("at.th").alias("th"))
    full = staged(whole_sets(docs, staged(picked, "minhash-picked"), words), "minhash-full")
    roots = components(confirmed_links(full, threshold, chunk_bytes)).withColumnRenamed("node", "g")
    member = staged(sets.select("g", "first").join(roots, "g", "left")
                    .select("g", "first", F.coalesce("root", "g").alias("root")), "minhash-members")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    names = staged(member.join(least, "root").select("g", "component_id"), "minhash-names")
    named = rows.select("doc_id", "n", "g").join(names, "g", "left") \
        .withColumn("component_id", F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def whole_sets(docs: DataFrame, picked: DataFrame, words: int) -> DataFrame:
    """``g, root, s``: the full sets of the digests in ``picked(g, root, d, th)``."""
    p = picked.select(F.col("g"), F.col("root"), F.col("d").alias("_d"), F.col("th").alias("_th"))
    texts = docs.select(F.col("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("b"))
    source = likely(texts, "th", picked).join(p, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_th"))).select("g", "root", "b")

    def run(batches):
        known: dict[bytes, int] = {}
        for b in batches:
            if len(known) > 1 << 19:
                known.clear()
            full = [shingle_set(x.as_py(), words, known) for x in b.column("b")]
            same = [digest(s) == g for s, g in zip(full, b.column("g").to_pylist())]  # a text of another hash twin
            yield pa.RecordBatch.from_arrays([b.column("g"), b.column("root"), pa.array([s.tobytes() for s in full], pa.binary())],
                                             ["g", "root", "s"]).filter(pa.array(same, pa.bool_()))

    return source.mapInArrow(run, "g long, root long, s binary").dropDuplicates(["g"])
