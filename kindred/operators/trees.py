"""Boosted trees as tables of root-to-leaf paths: Shapley contributions of
features, and leaf values with L1 / L2 regularisation.

What reaches the driver is the model: its nodes. Rows stay in the engine; the
paths go to them as one array literal.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """A path: conditions ``lo < x[f] <= hi`` on each feature it asks for
    (open ends are None), and the share ``z`` of the training weight that
    meets a feature's conditions where the path asks for them."""
    tree: int
    leaf: int             # in preorder, as the model numbers leaves
    value: float
    conditions: tuple     # of (f, lo, hi, z)


def stored_nodes(model: GBTClassificationModel) -> dict[int, dict]:
    """The model's nodes by tree and node number, as Spark stores them."""
    spark = SparkSession.builder.getOrCreate()  # also from a thread without a session of its own
    path = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    model.save(path)
    nodes: dict[int, dict] = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    return nodes


def leaves(model: GBTClassificationModel) -> list[Leaf]:
    """All paths of all trees, from the model's stored nodes."""
    nodes = stored_nodes(model)
    out = []
    for tree in sorted(nodes):
        n_leaf = 0
        todo = [(0, ())]  # preorder: the left child is taken first
        while todo:
            at, path_ = todo.pop()
            r = nodes[tree][at]
            if r["leftChild"] < 0:
                out.append(Leaf(tree, n_leaf, r["prediction"], _merged(path_)))
                n_leaf += 1
                continue
            if r["split"]["numCategories"] >= 0:
                raise ValueError("categorical splits are not supported")
            f, cut = r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0]
            all_ = r["impurityStats"][0]
            for child, lo, hi in ((r["rightChild"], cut, None), (r["leftChild"], None, cut)):
                todo.append((child, (*path_, (f, lo, hi, nodes[tree][child]["impurityStats"][0] / all_))))
    return out


def _merged(path: tuple) -> tuple:
    """One condition for each feature of a path."""
    by: dict[int, list] = {}
    for f, lo, hi, z in path:
        c = by.setdefault(f, [None, None, 1.0])
        c[0] = lo if c[0] is None else c[0] if lo is None else max(c[0], lo)
        c[1] = hi if c[1] is None else c[1] if hi is None else min(c[1], hi)
        c[2] *= z
    return tuple((f, *c) for f, c in by.items())


def literal(value, schema: str) -> Column:
    """A nested Python value as a constant column."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def base_value(model: GBTClassificationModel, paths: list[Leaf] | None = None) -> float:
    """The margin that contributions start from: its mean over training rows."""
    weights = model.treeWeights
    return sum(weights[p.tree] * p.value * math.prod(z for *_, z in p.conditions) for p in paths or leaves(model))


def contributions(data: DataFrame, model: GBTClassificationModel, key: str = "visitor_id", features: str = "features",
                  paths: list[Leaf] | None = None) -> DataFrame:
    """``key, feature, phi``: the Shapley value of each feature (by position)
    for each row's margin, features that a row set leaves open being averaged
    over the training rows as the trees split them. A row's values and
    ``base_value`` add up to its margin; features that no tree asks for have
    no row. ``key`` tells rows apart.

    A leaf with conditions on ``d`` features adds ``(o - z) * value * sum over
    k of weight(k) * coefficient(k)`` to each of them, where ``o`` is whether
    the row meets the condition and the coefficients are those of the product
    of ``z + o t`` over the other features.
    """
    weights = model.treeWeights
    table = [{"v": weights[p.tree] * p.value, "c": [dict(zip(("f", "lo", "hi", "z"), c)) for c in p.conditions],
              "w": [math.factorial(k) * math.factorial(len(p.conditions) - 1 - k) / math.factorial(len(p.conditions))
                    for k in range(len(p.conditions))]}
             for p in paths or leaves(model) if p.conditions]
    schema = "array<struct<v:double,c:array<struct<f:int,lo:double,hi:double,z:double>>,w:array<double>>>"
    rows = data.select(F.col(key), vector_to_array(features).alias("_x"))
    met = rows.select(key, "_x", F.explode(literal(table, schema)).alias("_l")).select(key, F.col("_l.v").alias("_v"), F.col("_l.w").alias("_w"), F.expr(
        "transform(_l.c, c -> named_struct('f', c.f, 'z', c.z, 'o', IF((c.lo IS NULL OR _x[c.f] > c.lo) AND (c.hi IS NULL OR _x[c.f] <= c.hi), 1D, 0D)))").alias("_c"))
    others = "filter(_c, (e, j) -> j <> i)"
    product = (f"aggregate({others}, array(1D), (p, e) -> zip_with(concat(transform(p, v -> v * e.z), array(0D)), "
               "concat(array(0D), transform(p, v -> v * e.o)), (a, b) -> a + b))")
    share = f"aggregate(zip_with({product}, _w, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    each = met.select(key, F.explode(F.expr(
        f"transform(_c, (c, i) -> named_struct('f', c.f, 'phi', _v * (c.o - c.z) * {share}))")).alias("_e"))
    return each.groupBy(key, F.col("_e.f").alias("feature")).agg(F.sum("_e.phi").alias("phi"))


def shapley_importance(data: DataFrame, model: GBTClassificationModel, n_features: int, key: str = "visitor_id",
                       features: str = "features") -> list[float]:
    """Mean absolute contribution of each feature over the rows of ``data``."""
    phi = contributions(data, model, key, features)
    found = {r["feature"]: r["s"] for r in phi.groupBy("feature").agg(F.sum(F.abs("phi")).alias("s")).collect()}
    n = data.count()
    return [found.get(f, 0.0) / n if n else 0.0 for f in range(n_features)]


# ---- leaf regularisation -------------------------------------------------------

def _values(model: GBTClassificationModel, paths: list[Leaf]) -> list[list[float]]:
    """Leaf values by tree and leaf."""
    out: list[list[float]] = [[] for _ in model.treeWeights]
    for p in paths:
        out[p.tree].append(p.value)
    return out


def _leaf_rows(data: DataFrame, model: GBTClassificationModel, features: str, *keep: str) -> DataFrame:
    with_leaf = model.copy()
    with_leaf.setLeafCol("_leaf")
    return with_leaf.transform(data.select(*keep, F.col(features).alias(model.getFeaturesCol()))) \
        .select(*keep, F.transform(vector_to_array("_leaf"), lambda x: x.cast("int")).alias("_leaf"))


def leaf_sums(data: DataFrame, model: GBTClassificationModel, features: str = "features", label: str = "label",
              weight: str = "weight", paths: list[Leaf] | None = None) -> DataFrame:
    """``tree, leaf, n, gradient, weight``: rows of each leaf, and the sums of
    their weighted pseudo-residuals at that tree's turn and of their weights,
    in one aggregate over all trees. (The first tree is fitted to the labels
    as -1 / 1, the others to the loss's negative gradient.)"""
    values = _values(model, paths or leaves(model))
    steps = [[w * v for v in tree] for w, tree in zip(model.treeWeights, values)]
    rows = _leaf_rows(data, model, features, label, weight).withColumn("_s", literal(steps, "array<array<double>>"))
    before = F.expr("aggregate(transform(_leaf, (l, t) -> _s[t][l]), array(0D), (p, v) -> concat(p, array(element_at(p, -1) + v)))")
    each = rows.select((2 * F.col(label) - 1).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"), "_leaf", before.alias("_b")) \
        .select("_y", "_w", "_b", F.posexplode("_leaf").alias("tree", "leaf"))
    residual = F.when(F.col("tree") == 0, F.col("_y")) \
        .otherwise(F.expr("4D * _y / (1D + exp(2D * _y * _b[tree]))"))
    return each.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_w") * residual).alias("gradient"),
                                            F.sum("_w").alias("weight"))


def regularised(sums: DataFrame, l2: float = 0.0, l1: float = 0.0) -> DataFrame:
    """``sums`` with ``value``: the gradient soft-thresholded by ``l1`` and
    shrunk by ``l2``. At 0 / 0 it is the leaf value the trees were fitted
    with, if they were fitted on the same rows without subsampling."""
    if l2 < 0 or l1 < 0:
        raise ValueError("regularisation must not be negative")
    g = F.col("gradient")
    return sums.withColumn("value", F.signum(g) * F.greatest(F.abs(g) - F.lit(float(l1)), F.lit(0.0)) / (F.col("weight") + F.lit(float(l2))))


def margin(data: DataFrame, model: GBTClassificationModel, values: DataFrame, key: str = "visitor_id",
           features: str = "features") -> DataFrame:
    """``key, margin, p1`` of the model with the leaf values of
    ``values(tree, leaf, value)``; leaves that are not in it keep theirs."""
    table = _values(model, leaves(model))
    for r in values.select("tree", "leaf", "value").collect():  # as many as the model has leaves
        table[r["tree"]][r["leaf"]] = r["value"]
    steps = [[w * v for v in tree] for w, tree in zip(model.treeWeights, table)]
    rows = _leaf_rows(data, model, features, key).withColumn("_s", literal(steps, "array<array<double>>"))
    total = F.expr("aggregate(transform(_leaf, (l, t) -> _s[t][l]), 0D, (s, v) -> s + v)")
    return rows.select(key, total.alias("margin")).withColumn("p1", 1 / (1 + F.exp(-2 * F.col("margin"))))
