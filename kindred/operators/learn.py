"""Learning operators on Spark ML: encoding, exact stratified splits and
folds, boosted trees, cross-validated random search, shadow-feature
selection, isotonic calibration and scoring.

Everything here is distributed: the label counts and model parameters are
the only things that reach the driver.
"""

from __future__ import annotations

import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.features import quoted
from kindred.operators.sample import row_hash
from kindred.operators.trees import literal, shapley_importance
from kindred.sources.session import materialize, scratch_path

KEY, LABEL = "visitor_id", "c_level"


def align_features(df: DataFrame, features: list[str], key: str = KEY, carry: tuple = ()) -> DataFrame:
    """Select ``features`` in order; features absent from ``df`` become 0.
    Columns ``carry`` come along unchanged."""
    have = set(df.columns)
    cols = [F.col(quoted(f)).cast("double").alias(f) if f in have else F.lit(0.0).alias(f) for f in features]
    return df.select(F.col(key), *[F.col(quoted(c)) for c in carry], *cols)


def cells(features: list[str]):
    """The features of a row as an array of doubles; any column name will do."""
    return F.array(*[F.col(quoted(f)).cast("double") for f in features])


def assemble(df: DataFrame, features: list[str], *keep: str, cuts: Cuts | None = None) -> DataFrame:
    """``keep`` and the feature vector, from the named columns; with ``cuts``
    the bins that the features fall into."""
    if cuts is None or cuts.places is None:
        return df.select(*keep, array_to_vector(cells(features)).alias("features"))
    rows = binned(df.select(*keep, cells(features).alias("_x")), "_x", cuts.of(features))
    return rows.select(*rows.columns[:-1], array_to_vector("_x").alias("features"))


def string_columns(df: DataFrame, exclude: tuple = (KEY,)) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def category_encoder(cols: list[str]) -> list[StringIndexer]:
    """Ordinal codes in sorted value order; unseen values get the next code.
    Fitted once on the training set and stored in the pipeline, so scoring
    uses the training codes."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_code", stringOrderType="alphabetAsc",
                          handleInvalid="keep") for c in cols]


# ---- exact, distributed ranking inside strata ---------------------------------

BUCKET_HEX = 4  # 65 536 hash buckets


def rank_by_hash(df: DataFrame, group_col: str, hash_col: str) -> DataFrame:
    """Add ``_rn``: 1-based position of each row inside its ``group_col`` in
    ascending ``hash_col`` (hex text) order — exact, without putting a group
    into one task.

    The leading hex digits of the hash cut the order into 65 536 contiguous
    buckets. Rows are ranked inside (group, bucket); per-bucket counts
    (at most groups x 65 536 rows) give each bucket's offset by a running
    sum, joined back by (group, bucket).
    """
    b = F.substring(F.col(hash_col), 1, BUCKET_HEX)
    local = df.withColumn("_bucket", b).withColumn(
        "_local", F.row_number().over(Window.partitionBy(group_col, "_bucket").orderBy(hash_col)))
    # counts come from the ranked rows, so the input is read once (the
    # window's exchange is shared by both branches)
    counts = local.groupBy(group_col, "_bucket").agg(F.max("_local").alias("_cnt"))
    run = Window.partitionBy(group_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, "_bucket",
                            F.coalesce(F.sum("_cnt").over(run), F.lit(0)).alias("_off"))
    return (local.join(offsets, [group_col, "_bucket"])
            .withColumn("_rn", (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_bucket", "_local", "_off"))


def stratify(df: DataFrame, label: str = LABEL, key: str = KEY, seed: int = 4222,
             holdout_every: int = 10, folds: int = 5) -> DataFrame:
    """Exact stratified hold-out and fold assignment.

    Inside each class, rows are ordered by ``md5(key|seed)``; the row at
    position ``rn`` is held out iff ``(rn - 1) % holdout_every == 0`` (so each
    class holds out ceil(n/holdout_every) rows). The remaining rows are
    numbered again in the same order and get ``fold = (rn - 1) % folds``.
    """
    ranked = rank_by_hash(df.withColumn("_h", row_hash(key, str(seed))), label, "_h")
    rn = F.col("_rn")
    holdout = ((rn - 1) % holdout_every) == 0
    # position among the class's non-held-out rows: rn minus the held-out
    # positions 1, 1 + k, 1 + 2k, ... at or before it
    train_rn = rn - (F.floor((rn - 1) / holdout_every) + 1)
    return (ranked.withColumn("holdout", holdout)
            .withColumn("fold", F.when(holdout, F.lit(None))
                        .otherwise(((train_rn - 1) % folds).cast("int")).cast("int"))
            .drop("_rn", "_h"))


# ---- where trees may split ------------------------------------------------------

SEEN = 10_000   # Spark ML looks for the splits of a feature in about so many rows
CUTS = 31       # splits a feature, as Spark ML has by default


@dataclass(frozen=True)
class Cuts:
    """The places at which trees may split, by feature, found in all of
    ``n_rows`` rows; None if Spark ML looks at that many rows itself."""
    n_rows: int
    places: dict | None = None

    @property
    def max_bins(self) -> int:
        """Spark ML reads ``max_bins`` squared rows for its splits: all of
        them. There are no more splits than bins that rows fall into."""
        return CUTS + 1 if self.places is None else max(CUTS + 1, math.isqrt(self.n_rows) + 1)

    def of(self, features: list[str]) -> list[np.ndarray]:
        return [self.places[f] for f in features]


def cut_points(df: DataFrame, features: list[str]) -> Cuts:
    """``Cuts`` of ``features`` over the rows of ``df``.

    A feature with few values is cut between all of them, another one where
    the rows up to a value come closest to each 32nd part of all (the rule of
    Spark ML, for whole rows). Values are counted in the tasks and sorted by
    feature; a task passes over the sorted counts and holds a batch of them.
    """
    n_rows, n = df.count(), len(features)
    if n_rows <= SEEN:
        return Cuts(n_rows)

    def counted(batches):
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            found = [np.unique(c[~np.isnan(c)], return_counts=True) for c in x.T]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(n, dtype=np.int32), [len(v) for v, _ in found])),
                 pa.array(np.concatenate([v for v, _ in found])), pa.array(np.concatenate([c for _, c in found]))], ["_f", "v", "c"])

    def cut(batches):
        at, walk = None, None
        for batch in batches:
            f, v, c = (batch.column(k).to_numpy() for k in ("_f", "v", "c"))
            starts = np.flatnonzero(np.diff(f, prepend=-1))
            for i, j in zip(starts, [*starts[1:], len(f)]):
                if f[i] != at:
                    if walk:
                        yield row(at, walk)
                    at, walk = f[i], _Walk(n_rows / (CUTS + 1))
                walk.add(v[i:j], c[i:j])
        if walk:
            yield row(at, walk)

    def row(f, walk):
        return pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([walk.end()], pa.list_(pa.float64()))], ["_f", "places"])

    counts = df.select(cells(features).alias("_x")).mapInArrow(counted, "_f int, v double, c long")
    found = counts.repartition("_f").sortWithinPartitions("_f", "v").mapInArrow(cut, "_f int, places array<double>").collect()
    places = {r["_f"]: r["places"] for r in found}  # a row a feature
    return Cuts(n_rows, {f: np.array(places.get(j, []), dtype=float) for j, f in enumerate(features)})


class _Walk:
    """One pass over the values of a feature and their counts, in order; a
    value may come in several parts."""

    def __init__(self, stride: float):
        self.stride, self.target = stride, stride
        self.first: list = []        # distinct values, until there are too many to cut between all
        self.cuts: list = []
        self.value, self.upto = None, 0   # the value before, and the rows up to it
        self.open = None             # the last value, which may go on

    def add(self, v: np.ndarray, c: np.ndarray) -> None:
        if self.open:
            v, c = np.append(self.open[0], v), np.append(self.open[1], c)
        starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        v, c = v[starts], np.add.reduceat(c, starts)
        self.open = (v[-1], c[-1])
        self._pass(v[:-1], c[:-1])

    def _pass(self, v: np.ndarray, c: np.ndarray) -> None:
        if not len(v):
            return
        if len(self.first) <= CUTS + 1:
            self.first += v[:CUTS + 2].tolist()
        upto = self.upto + np.cumsum(c)
        i = 0 if self.value is not None else 1
        while i < len(v):
            near = np.abs(upto[i:] - c[i:] - self.target) < np.abs(upto[i:] - self.target)
            k = i + int(near.argmax())
            if not near[k - i]:
                break
            self.cuts.append(between(float(v[k - 1]) if k else self.value, float(v[k])))
            self.target += self.stride
            i = k + 1
        self.value, self.upto = float(v[-1]), int(upto[-1])

    def end(self) -> list[float]:
        self._pass(np.array([self.open[0]]), np.array([self.open[1]]))
        if len(self.first) <= CUTS + 1:
            return [between(a, b) for a, b in zip(self.first, self.first[1:])]
        return self.cuts


def between(a: float, b: float) -> float:
    """A place that ``a`` is not above and ``b`` is."""
    m = (a + b) / 2
    return m if a <= m < b else a


def binned(df: DataFrame, col: str, places: list[np.ndarray]) -> DataFrame:
    """``df`` with the array ``col`` of features as the numbers of the bins
    that they fall into: how many cut points they are above."""
    at = df.columns.index(col)

    def numbers(batches):
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(places))
            bins = np.stack([np.searchsorted(p, c) for p, c in zip(places, x.T)], axis=1).astype(float)
            ends = np.arange(0, bins.size + 1, len(places), dtype=np.int32)
            yield batch.set_column(at, col, pa.ListArray.from_arrays(ends, bins.ravel()))

    return df.mapInArrow(numbers, df.schema)


def on_values(model: GBTClassificationModel, places: list[np.ndarray]) -> GBTClassificationModel:
    """A model fitted on ``binned`` features as one of the features."""
    spark = SparkSession.active()
    old, new = (scratch_path(spark, f"trees-{uuid.uuid4().hex}") for _ in range(2))
    model.save(old)
    split = "nodeData.split."
    below = F.get(F.get(literal([p.tolist() for p in places], "array<array<double>>"), F.col(split + "featureIndex")),
                  F.floor(F.col(split + "leftCategoriesOrThreshold")[0]).cast("int"))
    cut = F.when(F.col("nodeData.leftChild") >= 0, F.array(below)).otherwise(F.col(split + "leftCategoriesOrThreshold"))
    nodes = spark.read.parquet(f"{old}/data")
    nodes.withColumn("nodeData", F.col("nodeData").withField("split.leftCategoriesOrThreshold", cut)).write.parquet(f"{new}/data")
    spark.read.parquet(f"{old}/treesMetadata").write.parquet(f"{new}/treesMetadata")
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    return GBTClassificationModel.load(new)


# ---- boosted trees and search -------------------------------------------------

@dataclass
class TreeParams:
    max_iter: int = 20
    step_size: float = 0.1
    max_depth: int = 5
    subsampling_rate: float = 1.0
    feature_subset: float = 1.0
    min_info_gain: float = 0.0
    pos_weight: int = 1


def gbt(params: TreeParams, features_col: str = "features", label_col: str = "label",
        weight_col: str | None = "weight", seed: int = 4222, max_bins: int = CUTS + 1) -> GBTClassifier:
    kw = dict(featuresCol=features_col, labelCol=label_col, maxIter=params.max_iter,
              stepSize=params.step_size, maxDepth=params.max_depth, maxBins=max_bins,
              subsamplingRate=params.subsampling_rate, minInfoGain=params.min_info_gain,
              featureSubsetStrategy=("all" if params.feature_subset >= 1.0
                                     else str(round(params.feature_subset, 1))),
              seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return GBTClassifier(**kw)


def with_label_weight(df: DataFrame, pos_weight: float, label: str = LABEL) -> DataFrame:
    return (df.withColumn("label", F.col(label).cast("double"))
            .withColumn("weight", F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0))))


@dataclass(frozen=True)
class SearchSpace:
    """Ranges that parameters are drawn from, ends included; the defaults are
    those of the source system. Narrow a range to search less of it. Ranges
    that trees cannot be grown with are refused."""
    pos_weight: tuple[int, int] = (1, 5)
    step_size: tuple[float, float] = (1e-9, 1.0)      # log-uniform
    max_iter: tuple[int, int] = (1, 1000)
    max_depth: tuple[int, int] = (2, 13)
    row_tenths: tuple[int, int] = (1, 10)
    feature_tenths: tuple[int, int] = (1, 10)
    min_info_gain: tuple[int, int] = (0, 5)

    def __post_init__(self):
        if not (self.max_iter[0] >= 1 and self.max_depth[0] >= 1 and self.pos_weight[0] >= 1 and self.step_size[0] > 0
                and self.row_tenths[0] >= 1 and self.feature_tenths[0] >= 1 and self.min_info_gain[0] >= 0):
            raise ValueError("a search range starts below what a tree can be grown with")


def draw_params(n: int, seed: int, space: SearchSpace = SearchSpace()) -> list[TreeParams]:
    """Seeded random draws from ``space``."""
    rng = random.Random(seed)
    return [TreeParams(
        pos_weight=rng.randint(*space.pos_weight),
        step_size=math.exp(rng.uniform(*map(math.log, space.step_size))),
        max_iter=rng.randint(*space.max_iter),
        max_depth=rng.randint(*space.max_depth),
        subsampling_rate=rng.randint(*space.row_tenths) / 10,
        feature_subset=rng.randint(*space.feature_tenths) / 10,
        min_info_gain=float(rng.randint(*space.min_info_gain))) for _ in range(n)]


def fit_model(train: DataFrame, features: list[str], params: TreeParams, seed: int = 4222,
              cuts: Cuts | None = None) -> GBTClassificationModel:
    """Boosted trees on the assembled features (weighted positives). They
    split at ``cuts``, if not given those of all rows of ``train``."""
    cuts = cuts or cut_points(train, features)
    data = assemble(with_label_weight(train, params.pos_weight), features, "label", "weight", cuts=cuts)
    model = gbt(params, seed=seed, max_bins=cuts.max_bins).fit(data)
    return model if cuts.places is None else on_values(model, cuts.of(features))


def cross_validate(train: DataFrame, features: list[str], candidates: list[TreeParams], seed: int = 4222,
                   parallelism: int = 2, folds: int = 5, cuts: Cuts | None = None) -> tuple[TreeParams, list[float]]:
    """Mean weighted F1 over the precomputed folds for every candidate; the
    best candidate and all means. The rows are assembled once for all
    candidates (a positive weight is a column of its own on top of them), and
    fits of different folds and candidates run side by side. Trees split at
    ``cuts``, if not given those of all rows of ``train``."""
    evaluator = MulticlassClassificationEvaluator(metricName="f1", labelCol="label",
                                                  predictionCol="prediction")
    cuts = cuts or cut_points(train, features)
    data = assemble(with_label_weight(train, 1), features, "label", "fold", cuts=cuts).persist(StorageLevel.MEMORY_AND_DISK)

    def metric(job: tuple[int, int]) -> float:
        p, k = candidates[job[0]], job[1]
        rows = data.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(p.pos_weight))).otherwise(F.lit(1.0)))
        model = gbt(p, seed=seed, max_bins=cuts.max_bins).fit(rows.where(F.col("fold") != k))
        return evaluator.evaluate(model.transform(rows.where(F.col("fold") == k)))

    try:
        found = {r["fold"] for r in data.select("fold").distinct().collect()}
        if found != set(range(folds)):
            raise ValueError(f"folds 0 to {folds - 1} need rows each, and no row another fold; there are {found}")
        with ThreadPoolExecutor(max(parallelism, folds)) as pool:
            each = list(pool.map(metric, [(i, k) for i in range(len(candidates)) for k in range(folds)]))
    finally:
        data.unpersist()
    means = [float(m) for m in np.reshape(each, (len(candidates), folds)).mean(axis=1)]
    best = max(range(len(candidates)), key=lambda i: means[i])
    return candidates[best], means


def random_search(train: DataFrame, features: list[str], trials: int, seed: int = 4222,
                  space: SearchSpace = SearchSpace(), parallelism: int = 2, folds: int = 5):
    return cross_validate(train, features, draw_params(trials, seed, space), seed, parallelism, folds)


# ---- shadow-feature selection -------------------------------------------------

def _binom_cdf(k: int, n: int, p: float = 0.5) -> float:
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(0, k + 1))


def binomial_bounds(trials: int, alpha: float = 0.05) -> tuple[int, int]:
    """Hit counts at or below ``lo`` reject, at or above ``hi`` accept
    (two-sided test against a fair coin)."""
    lo = max([k for k in range(trials + 1) if _binom_cdf(k, trials) <= alpha / 2] or [-1])
    hi = min([k for k in range(trials + 1) if 1 - _binom_cdf(k - 1, trials) <= alpha / 2] or [trials + 1])
    return lo, hi


def ranked_cells(train: DataFrame, features: list[str], key: str = KEY, cuts: Cuts | None = None) -> DataFrame:
    """``_rn`` (from 0), label and the array ``x`` of features (with ``cuts``
    their bins), stored: the rows are ranked once for all trials."""
    rows = train.select(F.lit("all").alias("_g"), row_hash(key, "cells").alias("_h"), F.col(LABEL), cells(features).alias("x"))
    if cuts is not None and cuts.places is not None:
        rows = binned(rows, "x", cuts.of(features))
    ranked = rank_by_hash(rows, "_g", "_h")
    return materialize(ranked.select((F.col("_rn") - 1).alias("_rn"), LABEL, "x"), "cells")


BLOCK = 2048             # rows that are put together at once
CELLS = 1 << 20          # cells that are moved at once


def with_shadows(ranked: DataFrame, n_rows: int, n_features: int, seed: int) -> DataFrame:
    """The rows of ``ranked_cells`` with an array ``shadow``: feature ``j`` of
    row ``r`` stands in row ``a_j r + b_j`` modulo the row count, with ``a_j``
    prime to it, so every feature is permuted on its own.

    Cells move between blocks of ``BLOCK`` rows, those of one block that come
    from the same batch as one pair of buffers (places, values); a block meets
    its own rows once. A task holds a batch or a block, never a column.
    """
    rng = random.Random(seed)
    prime = [a for a in range(1, max(2, n_rows)) if math.gcd(a, n_rows) == 1] if n_rows <= 4096 else None

    def factor():
        while True:
            a = rng.choice(prime) if prime else rng.randrange(1, n_rows)
            if math.gcd(a, n_rows) == 1:
                return a

    a = np.array([factor() for _ in range(n_features)], dtype=np.int64)
    b = np.array([rng.randrange(max(1, n_rows)) for _ in range(n_features)], dtype=np.int64)
    step = max(1, CELLS // max(1, n_features))

    def moved(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False)
                rn = part.column("_rn").to_numpy()
                to = ((rn[:, None] * a + b) % n_rows).ravel()
                block = to // BLOCK
                order = np.argsort(block.astype(np.uint16) if n_rows <= BLOCK << 16 else block, kind="stable")
                place = ((to % BLOCK) * n_features + np.tile(np.arange(n_features), len(rn)))[order]
                x, block = x[order], block[order]
                ends = np.flatnonzero(np.diff(block, append=-1)) + 1
                starts = np.concatenate(([0], ends[:-1])).astype(int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[starts]), pa.array([place[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
                     pa.array([x[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())], ["_block", "place", "value"])

    def placed(rows, cells_):
        shadow = np.zeros(BLOCK * n_features)
        for place, value in zip(cells_.column("place"), cells_.column("value")):
            shadow[np.frombuffer(place.as_buffer(), np.int64)] = np.frombuffer(value.as_buffer())
        own = shadow.reshape(BLOCK, n_features)[rows.column("_rn").to_numpy() % BLOCK]
        ends = np.arange(0, own.size + 1, n_features, dtype=np.int32)
        return rows.select(names).append_column("shadow", pa.ListArray.from_arrays(ends, own.ravel()))

    names = ranked.columns
    chunks = ranked.select("_rn", "x").mapInArrow(moved, "_block long, place binary, value binary")
    own = ranked.withColumn("_block", F.floor(F.col("_rn") / BLOCK).cast("long"))
    schema = T.StructType([*ranked.schema.fields, T.StructField("shadow", T.ArrayType(T.DoubleType()))])
    return own.groupBy("_block").cogroup(chunks.groupBy("_block")).applyInArrow(placed, schema)


def shadow_selection(train: DataFrame, features: list[str], params: TreeParams, trials: int = 100,
                     seed: int = 4222, alpha: float = 0.05, parallelism: int = 4, importance: str = "gain",
                     cuts: Cuts | None = None) -> DataFrame:
    """Per feature: hits (trials where its importance beats the best shadow)
    and the decision accepted / tentative / rejected. ``alpha`` is shared
    out among the features. At least six trials are needed for a decision to
    be possible; fewer raise. Importance is the trees' gain, or with
    ``importance="shapley"`` the mean absolute Shapley contribution. A feature
    and its shadow are split at the same places: ``cuts``, if not given those
    of all rows of ``train``."""
    lo, hi = binomial_bounds(trials, alpha / max(1, len(features)))
    if lo < 0 or hi > trials:
        raise ValueError(f"{trials} trials cannot accept or reject any of {len(features)} features")
    n = len(features)
    cuts = cuts or cut_points(train, features)
    ranked = ranked_cells(train, features, cuts=cuts)
    n_rows = ranked.count()

    def trial(t: int) -> list[int]:
        # kept for the trial: the fit reads its rows several times
        both = with_label_weight(with_shadows(ranked, n_rows, n, seed + t), params.pos_weight).select(
            "_rn", "label", "weight", array_to_vector(F.concat("x", "shadow")).alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = gbt(params, seed=seed + t, max_bins=cuts.max_bins).fit(both)
            if importance == "shapley":
                imp = np.array(shapley_importance(both, model, 2 * n, key="_rn"))
            else:
                imp = model.featureImportances.toArray()
        finally:
            both.unpersist()
        return [int(v > imp[n:].max()) for v in imp[:n]]

    with ThreadPoolExecutor(parallelism) as pool:
        hits = [sum(h) for h in zip(*pool.map(trial, range(trials)))]
    rows = [(f, h, "accepted" if h >= hi else "rejected" if h <= lo else "tentative") for f, h in zip(features, hits)]
    return train.sparkSession.createDataFrame(rows, "feature string, hits int, decision string")


# ---- calibration and scoring ---------------------------------------------------

def positive_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("p1", vector_to_array("probability")[1])


def calibrate(model: GBTClassificationModel, train: DataFrame, features: list[str]) -> IsotonicRegressionModel:
    """Isotonic map from the model's P(1) to the label, fitted on ``train``."""
    p = positive_probability(model.transform(assemble(with_label_weight(train, 1), features, "label")))
    return IsotonicRegression(featuresCol="p1", labelCol="label", weightCol="weight", predictionCol="p_cal",
                              isotonic=True).fit(score_groups(p))


def score_groups(scored: DataFrame) -> DataFrame:
    """``p1, label, weight``: one row for each distinct score with its share
    of positives and its rows. The fit pools the same sums as over the rows,
    and gets as many rows as the model has distinct scores."""
    return scored.groupBy("p1").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))


def score(df: DataFrame, features: list[str], model: GBTClassificationModel, iso: IsotonicRegressionModel,
          key: str = KEY, carry: tuple = ()) -> DataFrame:
    """(key, raw and calibrated probability, predicted = probability > 0.5)."""
    c = iso.transform(positive_probability(model.transform(assemble(df, features, key, *carry))))
    return c.select(F.col(key), *carry, F.col("p1").alias("raw"), F.col("p_cal").alias("probability"),
                    (F.col("p_cal") > 0.5).cast("int").alias("predicted"))
