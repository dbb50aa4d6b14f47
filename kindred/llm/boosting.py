"""Small gradient-boosted trees: fitted by Spark on any number of labelled
rows or here on a few in memory, calibrated, and applied inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame

from kindred.operators.trees import stored_nodes

SCORE_PLACES = 3  # sums are rounded, so that many rows have few distinct ones


@dataclass
class Trees:
    """Complete trees of one depth: feature and threshold of each inner node
    in level order, value of each leaf; then the calibration of the sum."""
    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray      # trees x leaves
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        depth = self.value.shape[1].bit_length() - 1
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - len(f)]
        return np.round(total, SCORE_PLACES)

    def calibrated(self, s: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * s + self.shift, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x))


def _best_split(x, cuts, g, h, rows):
    """Feature and threshold with the largest gain; no gain: a split that
    sends every row left."""
    best = (1e-6, 0, np.inf)
    gs, hs = g[rows].sum(), h[rows].sum()
    for f, c in enumerate(cuts):
        if not len(c):
            continue
        bin_ = np.searchsorted(c, x[rows, f], side="left")
        gl = np.bincount(bin_, g[rows], len(c) + 1).cumsum()[:-1]
        hl = np.bincount(bin_, h[rows], len(c) + 1).cumsum()[:-1]
        gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], f, c[k])
    return best[1], best[2]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2) -> Trees:
    """Logistic loss, second-order steps, up to 32 cut points a feature."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, 33)[:-1])) for col in x.T]
    cuts = [c[c < col.max()] for c, col in zip(cuts, x.T)]
    inner, score = 2 ** depth - 1, np.zeros(len(x))
    feature, threshold = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    for k in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(x), dtype=np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) > 1:
                feature[k, node], threshold[k, node] = _best_split(x, cuts, g, h, rows)
            at[rows] = 2 * node + 1 + (x[rows, feature[k, node]] > threshold[k, node])
        leaf = at - inner
        value[k] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += value[k][leaf]
    return Trees(feature, threshold, value)


def fit_rows(rows: DataFrame, trees: int = 60, depth: int = 3, rate: float = 0.2) -> Trees:
    """Trees fitted by Spark on all of ``rows(x array<double>, y, n)``, ``n``
    being how many rows one stands for. Spark ML grows them from bin sums of
    every row (it looks for the bins' ends, up to 64 a feature, in a part of
    the rows); only the trees come to the driver."""
    model = GBTClassifier(labelCol="y", weightCol="n", maxIter=trees, maxDepth=depth, stepSize=rate, maxBins=64, seed=1).fit(
        rows.select(array_to_vector("x").alias("features"), "y", "n"))
    inner, nodes = 2 ** depth - 1, stored_nodes(model)
    out = Trees(np.zeros((len(nodes), inner), dtype=np.int64), np.full((len(nodes), inner), np.inf), np.zeros((len(nodes), inner + 1)))
    for k, weight in enumerate(model.treeWeights):
        todo = [(0, 0)]
        while todo:
            node, at = todo.pop()
            r = nodes[k][node]
            if r["leftChild"] >= 0:
                out.feature[k, at], out.threshold[k, at] = r["split"]["featureIndex"], r["split"]["leftCategoriesOrThreshold"][0]
                todo += [(r["leftChild"], 2 * at + 1), (r["rightChild"], 2 * at + 2)]
                continue
            first = last = at  # every place below a leaf has its value
            while first < inner:
                first, last = 2 * first + 1, 2 * last + 2
            out.value[k, first - inner:last - inner + 1] = weight * r["prediction"]
    return out


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, steps: int = 50) -> Trees:
    """Platt scaling on held-out rows: logistic regression of ``y`` on the sum."""
    return calibrate_sums(model, model.raw(x), y, np.ones(len(y)), steps)


def calibrate_sums(model: Trees, s: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 50) -> Trees:
    """The same from sums ``s`` and labels that stand for ``n`` rows each."""
    w = np.array([1.0, 0.0])
    a = np.stack([s, np.ones_like(s)], axis=1)
    pos, neg = (n * y).sum(), (n * (1 - y)).sum()
    soft = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        hess = a.T @ (a * (n * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, a.T @ (n * (soft - p))), -2, 2)
    model.scale, model.shift = float(max(w[0], 1e-3)), float(w[1])
    return model
