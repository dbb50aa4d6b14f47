"""Hard negatives by exact integer inner products.

Vectors are scaled to integers. Scores of a block of anchors with a block of
rows are matrix products of residues: for each of several small primes one
float32 product whose sums stay below 2**24 and so are exact; the Chinese
remainder theorem (mixed radix) gives the signed score back. The number of
primes follows from a bound on the scores.

Two passes over all rows: the first keeps every anchor's best positives, the
second the best negatives whose score lies in a window below each positive's.
A task keeps the best of what it has seen of an anchor and passes on only
those; blocks of anchors are joined to the blocks of rows, broadcast if small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import staged

EXACT = 1 << 24            # float32 holds every integer up to here
WIDEST = 1 << 50           # bound on scores: a score and a place in a block share an int64
NONE = np.iinfo(np.int64).min + 1


def primes_for(dims: int, bound: int) -> tuple[list[int], int]:
    """Primes whose product exceeds twice ``bound``, and how many components a
    float32 sum of products of their residues may run over."""
    width = min(max(1, dims), 1024)
    top = 2 * int((EXACT / width) ** 0.5) + 1
    found, product, p = [], 1, top
    while product <= 2 * bound:
        if p < 3:
            raise ValueError("no primes left")
        if all(p % q for q in range(2, int(p ** 0.5) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found, width


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Signed residues of int64 numbers, within half of ``p``."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def exact_products(a: np.ndarray, b: np.ndarray, primes: list[int], width: int) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact while within half of the primes'
    product on either side."""
    score = np.zeros((len(a), len(b)), dtype=np.int64)
    product = 1
    for p in primes:
        ra, rb = residues(a, p), residues(b, p)
        r = np.zeros(score.shape, dtype=np.int64)
        for at in range(0, a.shape[1], width):
            r += (ra[:, at:at + width] @ rb[:, at:at + width].T).astype(np.int64)
        # The next mixed-radix digit: what is still missing modulo p.
        digit = np.mod((np.mod(r - score, p)) * pow(product, -1, p), p)
        score += digit * product
        product *= p
    return np.where(score > product // 2, score - product, score)


def scaled(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, v``: rows that take part, components ``floor(scale * x)``."""
    v = F.col(vec_col).cast("array<double>")
    good = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("x")) \
        .where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL "
               "AND forall(x, y -> y IS NOT NULL AND NOT isnan(y) AND abs(y) < double('inf'))")
    return good.select("id", "label", F.transform("x", lambda y: F.floor(y * F.lit(float(scale))).cast("long")).alias("v"))


def blocks(rows: DataFrame, block_rows: int, name: str) -> DataFrame:
    """Rows packed into ``dims, block, ids, labels, keys, vs`` (binary int64), each
    block of at most some ``block_rows`` rows of one vector size."""
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")) \
        .select("dims", F.ceil(F.col("n") / block_rows).cast("int").alias("q"))
    dealt = rows.withColumn("dims", F.size("v")).join(F.broadcast(sizes), "dims") \
        .withColumn("block", F.expr("cast(pmod(xxhash64(id, v), q) AS int)"))
    lists = dealt.groupBy("dims", "block").agg(F.collect_list(F.struct("id", "label", "key", "v")).alias("rows"))

    def pack(batches):
        for b in batches:
            out = []
            for x in b.column("rows"):
                ids, labels, keys = (x.values.field(c).to_numpy() for c in ("id", "label", "key"))
                order = np.argsort(ids, kind="stable")
                v = x.values.field("v").flatten().to_numpy().reshape(len(ids), -1)
                out.append([np.ascontiguousarray(y[order], dtype=np.int64).tobytes() for y in (ids, labels, keys, v)])
            yield pa.RecordBatch.from_arrays([b.column("dims"), b.column("block"), *(pa.array([o[i] for o in out], pa.binary()) for i in range(4))],
                                             ["dims", "block", "ids", "labels", "keys", "vs"])

    return staged(lists.mapInArrow(pack, "dims int, block int, ids binary, labels binary, keys binary, vs binary"), name)


def unpack(b: pa.RecordBatch, i: int, prefix: str = ""):
    ids, labels, keys, v = (np.frombuffer(b.column(prefix + c)[i].as_py(), dtype=np.int64) for c in ("ids", "labels", "keys", "vs"))
    return ids, labels, keys, v.reshape(len(ids), -1)


def meet(rows: DataFrame, anchors: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Every block of rows beside every block of anchors of its vector size;
    the anchors are broadcast up to ``broadcast_bytes``, and else copied to
    ``share`` groups of row blocks and joined by a shuffle."""
    have = anchors.agg(F.sum(F.octet_length("vs") + F.octet_length("ids"))).first()[0] or 0
    a = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    if have <= broadcast_bytes:
        return rows.repartition("dims", "block").join(F.broadcast(a), F.col("dims") == F.col("a_dims"))
    shares = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    a = a.withColumn("a_share", F.explode(F.expr(f"sequence(0, {shares - 1})")))
    return rows.withColumn("share", F.expr(f"cast(pmod(xxhash64(block), {shares}) AS int)")) \
        .join(a, (F.col("dims") == F.col("a_dims")) & (F.col("share") == F.col("a_share")))


def best(keys: list[np.ndarray], score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each key, best first: higher score, then
    smaller id."""
    order = np.lexsort((ids, -score, *keys))
    if not len(order):
        return order
    new = np.r_[True, np.any([x[order][1:] != x[order][:-1] for x in keys], axis=0)]
    first = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


class Best:
    """Running best ``k`` of each key (a tuple of columns); passed on and
    emptied once it holds ``limit`` entries."""

    def __init__(self, width: int, k: int, limit: int = 1 << 20):
        self.width, self.k, self.limit = width, k, limit
        self.clear()

    def clear(self):
        self.held, self.new = np.zeros((self.width + 2, 0), dtype=np.int64), []
        self.waiting = 0

    def add(self, keys: list[np.ndarray], score: np.ndarray, ids: np.ndarray):
        self.new.append(np.array([*keys, score, ids], dtype=np.int64).reshape(self.width + 2, -1))
        self.waiting += len(ids)
        if self.waiting > max(1 << 18, self.held.shape[1]):
            self.fold()

    def fold(self):
        x = np.concatenate([self.held, *self.new], axis=1)
        self.held, self.new, self.waiting = x[:, best(list(x[:self.width]), x[-2], x[-1], self.k)], [], 0

    def full(self) -> bool:
        return self.held.shape[1] > self.limit

    def batch(self, names: list[str]) -> pa.RecordBatch:
        self.fold()
        out = pa.RecordBatch.from_arrays([pa.array(c) for c in self.held], names)
        self.clear()
        return out


def top(df: DataFrame, keys: list[str], id_col: str, k: int) -> DataFrame:
    """The ``k`` best rows of each key with ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), id_col)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         anchor: str = "id % 100 = 0", relabel: str = "label", positives: int = 5, negatives: int = 5,
         scale: int = 256, window: tuple[int, int] = (80, 100), block_rows: int = 2048,
         broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.

    Scores are inner products of ``floor(scale * x)``; higher scores come
    first, ties by the smaller id. ``anchor`` and ``relabel`` are expressions
    over ``id`` and ``label``. A positive is one of an anchor's first
    ``positives`` other rows of its label; its negatives are the first
    ``negatives`` rows of another label with ``window[0] * positive_score <=
    100 * negative_score <= window[1] * positive_score``, ``rank`` from 1.

    No part take rows with a null id, label or vector or with a null or
    non-finite component. Repeated rows (id, label, vector) count once; other
    rows that share an id are rows of their own, but do not meet each other. Vectors of different sizes do not meet. An anchor
    without positives, and a positive without negatives, give no row; nor do
    positives below 0, whose window is empty. Scores that could exceed 2**50
    raise ``ValueError``. An empty table gives no row.
    """
    low, high = window
    rows = scaled(vectors, id_col, vec_col, label_col, scale).withColumn("label", F.expr(relabel).cast("long")) \
        .where("label IS NOT NULL").distinct().withColumn("key", F.xxhash64("id", "label", "v"))
    rows = staged(rows, "negatives-rows")
    shape = rows.agg(F.max(F.size("v")), F.max(F.expr("array_max(transform(v, y -> abs(cast(y AS double))))"))).first()
    dims, most = int(shape[0] or 0), int(shape[1] or 0)
    if dims * most * most > WIDEST:
        raise ValueError(f"scores of {dims} components up to {most} can exceed {WIDEST}")
    primes, width = primes_for(dims, dims * most * most)
    packed = blocks(rows, block_rows, "negatives-blocks")
    asked = blocks(rows.where(anchor), block_rows // 2, "negatives-anchors")

    def find_positives(batches):
        kept = Best(2, positives)
        for b in batches:
            for i in range(b.num_rows):
                (ids, labels, _, v), (a_ids, a_labels, a_keys, a_v) = unpack(b, i), unpack(b, i, "a_")
                score = exact_products(a_v, v, primes, width)
                good = (a_labels[:, None] == labels) & (a_ids[:, None] != ids)
                # Ids ascend in a block: score and place in one number order as score, then smaller id.
                both = np.where(good, score * len(ids) + np.arange(len(ids))[::-1], NONE)
                n = min(positives, len(ids))
                some = np.argpartition(-both, n - 1, axis=1)[:, :n]
                r, c = np.repeat(np.arange(len(a_ids)), n), some.ravel()
                ok = good[r, c]
                r, c = r[ok], c[ok]
                kept.add([a_ids[r], a_keys[r]], score[r, c], ids[c])
            if kept.full():
                yield kept.batch(["anchor_id", "key", "score", "id"])
        yield kept.batch(["anchor_id", "key", "score", "id"])

    found = meet(packed, asked, broadcast_bytes).mapInArrow(find_positives, "anchor_id long, key long, score long, id long")
    pairs = top(found, ["anchor_id", "key"], "id", positives).select("key", F.col("id").alias("p"), F.col("score").alias("s"))
    goals = goal_blocks(rows.where(anchor), staged(pairs.distinct(), "negatives-positives"), block_rows // 2)
    names = ["anchor_id", "key", "positive_id", "positive_score", "score", "id"]

    def find_negatives(batches):
        kept = Best(4, negatives)
        for b in batches:
            for i in range(b.num_rows):
                (ids, labels, _, v), (a_ids, a_labels, a_keys, a_v) = unpack(b, i), unpack(b, i, "a_")
                ends = np.frombuffer(b.column("a_ends")[i].as_py(), dtype=np.int64)
                p, s = (np.frombuffer(b.column(c)[i].as_py(), dtype=np.int64) for c in ("a_p", "a_s"))
                score = exact_products(a_v, v, primes, width)
                start = np.r_[0, ends[:-1]]
                lowest, highest = np.minimum.reduceat(s, start), np.maximum.reduceat(s, start)
                r, c = np.nonzero((100 * score >= low * lowest[:, None]) & (100 * score <= high * highest[:, None])
                                  & (a_labels[:, None] != labels) & (a_ids[:, None] != ids))
                x = score[r, c]
                for n in range(int((ends - start).max(initial=0))):  # the anchors' n-th positive
                    has = start + n < ends
                    at = np.where(has, start + n, 0)[r]
                    ok = has[r] & (low * s[at] <= 100 * x) & (100 * x <= high * s[at])
                    if ok.any():
                        at, y, z = at[ok], x[ok], ids[c[ok]]
                        first = best([at], y, z, negatives)
                        mine_ = r[ok][first]
                        kept.add([a_ids[mine_], a_keys[mine_], p[at][first], s[at][first]], y[first], z[first])
            if kept.full():
                yield kept.batch(names)
        yield kept.batch(names)

    found = meet(packed, goals, broadcast_bytes).mapInArrow(
        find_negatives, "anchor_id long, key long, positive_id long, positive_score long, score long, id long")
    return top(found, ["anchor_id", "key", "positive_id", "positive_score"], "id", negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def goal_blocks(anchors: DataFrame, pairs: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of the anchors that have positives, as ``blocks`` packs them,
    with ids ``p`` and scores ``s`` of ``pairs(key, p, s)`` and where each
    anchor's end."""
    goals = pairs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("s", "p"))).alias("goals"))  # a few of each
    rows = anchors.join(goals, "key").withColumn("dims", F.size("v"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n")).select("dims", F.ceil(F.col("n") / block_rows).cast("int").alias("q"))
    lists = rows.join(F.broadcast(sizes), "dims").withColumn("block", F.expr("cast(pmod(xxhash64(id, v), q) AS int)")) \
        .groupBy("dims", "block").agg(F.collect_list(F.struct("id", "label", "key", "v", "goals")).alias("rows"))

    def pack(batches):
        for b in batches:
            out = []
            for x in b.column("rows"):
                f = x.values.field
                flat = f("goals").flatten()
                out.append([np.ascontiguousarray(y, dtype=np.int64).tobytes() for y in (
                    f("id").to_numpy(), f("label").to_numpy(), f("key").to_numpy(), f("v").flatten().to_numpy(),
                    np.cumsum(f("goals").value_lengths().to_numpy()), flat.field("p").to_numpy(), flat.field("s").to_numpy())])
            yield pa.RecordBatch.from_arrays([b.column("dims"), b.column("block"), *(pa.array([o[i] for o in out], pa.binary()) for i in range(7))],
                                             ["dims", "block", "ids", "labels", "keys", "vs", "ends", "p", "s"])

    return staged(lists.mapInArrow(pack, "dims int, block int, ids binary, labels binary, keys binary, vs binary, ends binary, p binary, s binary"),
                  "negatives-goals")
