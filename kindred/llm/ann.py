"""Approximate nearest neighbours: a forest of random-projection trees.

The trees are fitted on a bounded sample; every vector is then filed under
its leaf of each tree. A query walks all trees through one priority queue,
always opening the node whose split planes it lies least far beyond, until
the leaves it has opened hold ``search_share`` of all filed entries. The
opened leaves' vectors are ranked by exact distance.

Rows with equal vectors are one class before filing: of each class the ``k +
1`` smallest ids can be among a query's ``k`` nearest, so the rest need not
be compared. Large leaves and their queries are dealt out in blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import staged


class Forest:
    """Split planes of all trees in arrays; a child below 0 is leaf ``-1 - c``."""

    def __init__(self, sample: np.ndarray, trees: int, leaf_rows: int, seed: int):
        self.planes, self.offsets, self.children = [], [], []
        self.leaves, self.roots = 0, []
        self.seed = seed
        for t in range(trees):
            self.roots.append(self._grow(sample, leaf_rows, np.random.default_rng([seed, t])))
        self.planes = np.array(self.planes, dtype=np.float64).reshape(len(self.planes), sample.shape[1])
        self.offsets = np.array(self.offsets, dtype=np.float64)
        self.children = np.array(self.children, dtype=np.int64).reshape(-1, 2)

    def _grow(self, sample, leaf_rows, rng) -> int:
        """Splits by the plane between two centres drawn towards two random
        rows; returns the root. Works off a stack, as trees can be deep."""
        hold = [0]
        todo = [(np.arange(len(sample)), hold, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(sample, rows, rng) if len(rows) > leaf_rows else None
            if split is None:
                parent[side] = -1 - self.leaves
                self.leaves += 1
                continue
            plane, offset, low = split
            parent[side] = len(self.planes)
            self.planes.append(plane)
            self.offsets.append(offset)
            self.children.append([0, 0])
            todo.append((rows[low], self.children[-1], 0))
            todo.append((rows[~low], self.children[-1], 1))
        return hold[0]

    @staticmethod
    def _split(sample, rows, rng):
        near = sample[rng.choice(rows, min(len(rows), 512), replace=False)]
        a, b = near[rng.choice(len(near), 2, replace=False)]
        for _ in range(10):
            first = near @ (a - b) > (a @ a - b @ b) / 2
            if first.all() or not first.any():
                break
            a, b = near[first].mean(axis=0), near[~first].mean(axis=0)
        size = np.linalg.norm(a - b)
        if not size > 0:
            return None
        plane = (a - b) / size
        offset = float((a + b) @ plane / 2)
        low = sample[rows] @ plane < offset
        return None if low.all() or not low.any() else (plane, offset, low)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of ``x`` in each tree."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root, dtype=np.int64)
            while (live := np.flatnonzero(at >= 0)).size:
                n = at[live]
                high = np.einsum("ij,ij->i", x[live], self.planes[n]) >= self.offsets[n]
                at[live] = self.children[n, high.astype(np.int64)]
            out[:, t] = -1 - at
        return out

    def search(self, q: np.ndarray, held: np.ndarray, enough: float) -> list[int]:
        """Leaves in the order of the shared queue until they hold ``enough``."""
        margin = self.planes @ q - self.offsets
        queue = [(-np.inf, r) for r in self.roots]
        found, n = [], 0
        while queue and n < enough:
            far, at = heapq.heappop(queue)
            if at < 0:
                found.append(-1 - at)
                n += held[-1 - at]
                continue
            m = margin[at]
            heapq.heappush(queue, (max(far, m), int(self.children[at, 0])))
            heapq.heappush(queue, (max(far, -m), int(self.children[at, 1])))
        return found


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v`` of rows whose vector takes part: not null, not zero, no null
    or non-finite component, of the most common size (ties: the smaller);
    the row has an id."""
    v = F.col(vec_col)
    if vectors.schema[vec_col].dataType.elementType.simpleString() != "float":
        v = v.cast("array<double>")
    good = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v")) \
        .where("size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) "
               "AND exists(v, x -> x <> 0)")
    sizes = good.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return good.where(F.size("v") == (sizes["n"] if sizes else 0))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query: str = "id % 100 = 0",
            k: int = 10, trees: int = 8, leaf_rows: int = 32, fit_rows: int = 20_000, search_share: float = 1.0,
            block_rows: int = 2048, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``query``
    (over the column ``id``) its ``k`` nearest found among all other rows,
    by Euclidean distance in double precision, ties to the smaller id.

    ``fit_rows`` bounds the sample the trees are fitted on; every row is
    filed, once a tree. A query stops once its leaves hold ``search_share``
    entries for each row of the table, rows met in several trees counted
    each time (``trees``: it searches everything). If ids repeat, rows
    of one id are all candidates and an id is listed once, at its least
    distance; a query never meets rows of its own id. Rows outside
    ``valid_vectors`` take no part; an empty table gives no row.
    """
    good = staged(valid_vectors(vectors, id_col, vec_col).distinct(), "ann-vectors")
    spark = good.sparkSession
    copies = Window.partitionBy("v").orderBy("id")
    kept = staged(good.withColumn("n", F.row_number().over(copies)).where(f"n <= {k + 1}").drop("n"), "ann-kept")
    sample = kept.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(fit_rows).select("v").toPandas()["v"]
    fit = np.array([np.asarray(x, dtype=np.float64) for x in sample]) if len(sample) else np.zeros((0, 1))
    forest = Forest(fit, trees, leaf_rows, seed)
    shared = spark.sparkContext.broadcast(forest)

    def file_rows(batches):
        for b in batches:
            if b.num_rows:
                leaf = shared.value.leaves_of(matrix(b.column("v")))
                each = np.repeat(np.arange(b.num_rows), leaf.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(leaf.ravel()), b.column("id").take(pa.array(each))], ["leaf", "id"])

    filed = staged(kept.mapInArrow(file_rows, "leaf long, id long"), "ann-filed")
    held = np.zeros(max(1, forest.leaves), dtype=np.int64)
    for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # one row a leaf: bounded by the forest
        held[r["leaf"]] = r["n"]
    counts = spark.sparkContext.broadcast(held)
    enough = search_share * held.sum() / max(1, trees)

    def walk(batches):
        for b in batches:
            x = matrix(b.column("v"))
            opened = [shared.value.search(q, counts.value, enough) for q in x]
            each = np.repeat(np.arange(len(opened)), [len(o) for o in opened])
            flat = np.array([n for o in opened for n in o], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(counts.value[flat]), *(b.column(c).take(pa.array(each)) for c in ("id", "v"))],
                ["leaf", "held", "id", "v"])

    asked = good.where(query).mapInArrow(walk, f"leaf long, held long, id long, v {kept.schema['v'].dataType.simpleString()}")
    # Rows of a leaf meet its queries in blocks: rows by hash into chunks, queries likewise.
    chunk = f"cast(pmod(xxhash64(id), greatest(1L, cast(ceil(held / {block_rows}) AS LONG))) AS INT)"
    sized = spark.createDataFrame([(i, int(n)) for i, n in enumerate(held.tolist())], "leaf long, held long")
    rows = filed.join(F.broadcast(sized), "leaf").join(kept, "id") \
        .groupBy("leaf", F.expr(chunk).alias("c")).agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    asks = asked.withColumn("qc", F.expr("cast(pmod(xxhash64(id), 64) AS INT)")) \
        .groupBy("leaf", "qc").agg(F.collect_list(F.struct("id", "v")).alias("asks"))
    met = asks.join(rows, "leaf").select("asks", "rows")

    def rank(batches):
        best: dict[int, tuple] = {}
        for b in batches:
            for asks_, rows_ in zip(b.column("asks"), b.column("rows")):
                qi, q = parts(asks_.values)
                ri, r = parts(rows_.values)
                for i, v in zip(qi.tolist(), q):
                    other = ri != i
                    d = np.sqrt(((r[other] - v) ** 2).sum(axis=1))
                    ids = ri[other]
                    if i in best:
                        ids, d = np.concatenate([best[i][0], ids]), np.concatenate([best[i][1], d])
                    best[i] = smallest(ids, d, k)
            if len(best) > 20_000:
                yield found(best)
                best = {}
        yield found(best)

    top = met.mapInArrow(rank, "query_id long, vec_id long, score double") \
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return top.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}") \
        .select("query_id", "rank", "vec_id", "score")


def matrix(col) -> np.ndarray:
    """An Arrow list column of equal sizes as a matrix."""
    n = len(col)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def parts(structs) -> tuple[np.ndarray, np.ndarray]:
    return structs.field("id").to_numpy(zero_copy_only=False), matrix(structs.field("v"))


def smallest(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` least distances, ties to the smaller id, each id once."""
    order = np.lexsort((ids, d))
    ids, d = ids[order], d[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], d[first]


def found(best: dict) -> pa.RecordBatch:
    q = np.repeat(np.array(list(best), dtype=np.int64), [len(x[0]) for x in best.values()])
    ids = np.concatenate([np.zeros(0, dtype=np.int64), *(x[0] for x in best.values())])
    d = np.concatenate([np.zeros(0), *(x[1] for x in best.values())])
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(d)], ["query_id", "vec_id", "score"])
