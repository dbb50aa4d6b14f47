"""The stages as Spark plans: build visitor features, label them, train and
calibrate a scorer, score unlabelled visitors, compare the populations.

Results that are read several times are stored as tables in the shared
checkpoint folder, which also cuts their lineage.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import enrich as en
from kindred.operators import features as fe
from kindred.operators import learn as ln
from kindred.operators.metrics import weighted_f1
from kindred.operators.compare import (class_from_label, class_from_prediction, compare_populations, mix_of_views,
                                       visitor_views)
from kindred.operators.sample import dedupe, sample_once
from kindred.operators.search import sequential_search
from kindred.sources.buckets import bucket_count, write_bucketed
from kindred.sources.session import materialize, scratch_path
from kindred.sources.sinks import append_run, write_table
from kindred.sources.tables import lowercase_columns


@dataclass
class TrainConfig:
    seed: int = 4222
    holdout_every: int = 10
    folds: int = 5
    selection_search_trials: int = 10
    selection_trials: int = 100
    final_search_trials: int = 60
    selection_space: ln.SearchSpace = ln.SearchSpace()
    final_space: ln.SearchSpace = ln.SearchSpace()
    parallelism: int = 2
    selection_importance: str = "shapley"   # or "gain"
    # Where the searches keep their trials, to go on after a stop (optional).
    history: str | None = None
    model_version: str = "kindred-1"
    training_date: str | None = None


@dataclass
class Artifacts:
    features: list
    encoders: PipelineModel
    model: GBTClassificationModel
    calibrator: IsotonicRegressionModel
    categories: list = field(default_factory=list)   # columns the encoders read
    codes: list = field(default_factory=list)        # and the columns they add
    report: dict = field(default_factory=dict)


def training_rows(views: DataFrame, content: DataFrame, category: DataFrame, sentiment: DataFrame,
                  seed_labels: DataFrame, start: str, end: str,
                  zone: str = "America/New_York") -> DataFrame:
    """Stage 1 rows for labelled visitors (window, semi join, article /
    category / sentiment joins)."""
    return en.raw_rows(views, content, category, sentiment, start, end, labelled=seed_labels, zone=zone)


def visitor_features(rows: DataFrame, all_views: DataFrame, subscriptions: DataFrame,
                     resources: list[str], cfg: fe.FeatureConfig = fe.FeatureConfig()) -> DataFrame:
    """Stage 1: joined rows -> wide features + newsletter and subscriber flags."""
    wide = fe.build_wide(rows, cfg)
    return en.add_flags(wide, rows, subscriptions, all_views, resources)


def training_set(features: DataFrame, seed_labels: DataFrame) -> DataFrame:
    """Stage 2: features joined with the labels, ``c_level`` 1/0, one row per
    (visitor, class) — labels are de-duplicated before the join, which is the
    same as de-duplicating after it since features hold one row per visitor."""
    labels = seed_labels.select(
        "visitor_id", "management_level",
        F.when(F.col("management_level") == "C-Level", 1).otherwise(0).alias("c_level"),
        "user_name")
    labels = dedupe(labels, ["visitor_id", "c_level"], ["management_level", "user_name"]).drop("user_name")
    return lowercase_columns(features.join(labels, "visitor_id"))


def label_rows(seed_labels: DataFrame) -> DataFrame:
    """Labels as they are stored: a row for each visitor and level, with the
    number of label rows it stands for. Labels without a visitor join nothing."""
    return (seed_labels.where(F.col("visitor_id").isNotNull()).groupBy("visitor_id", "management_level")
            .agg(F.min("user_name").alias("user_name"), F.count(F.lit(1)).alias("n_rows")))


def labelled_views(views: DataFrame, labels: DataFrame) -> DataFrame:
    """``visitor_views`` joined with ``label_rows``: views by class, counted
    once for each label row of the visitor."""
    return views.join(labels.select("visitor_id", "management_level", "n_rows"), "visitor_id").select(
        "visitor_id", "dimension", "category", (F.col("page_views") * F.col("n_rows")).alias("page_views"),
        class_from_label().alias("c_level"))


def scored_views(views: DataFrame, scores: DataFrame) -> DataFrame:
    """``visitor_views`` joined with the predictions: views by class."""
    return views.join(scores.select("visitor_id", "predicted"), "visitor_id") \
        .select(*views.columns, class_from_prediction().alias("c_level"))


def train(train_set: DataFrame, cfg: TrainConfig = TrainConfig()) -> Artifacts:
    """Stage 3: encode, split, search, select, fit, calibrate, evaluate. Every
    step reads all labelled rows."""
    data = materialize(train_set.drop("management_level").na.fill(0), "train")
    cats = ln.string_columns(data)
    encoders = PipelineModel(stages=[ix.fit(data) for ix in ln.category_encoder(cats)])
    codes = [s.getOutputCol() for s in encoders.stages]
    features = [c for c in data.columns if c not in cats + [ln.KEY, ln.LABEL]] + codes
    split = materialize(ln.stratify(encoders.transform(data), seed=cfg.seed, holdout_every=cfg.holdout_every,
                                    folds=cfg.folds), "split")
    fit_rows = split.where(~F.col("holdout"))
    cuts = ln.cut_points(fit_rows, features)
    trials = {k: os.path.join(cfg.history, k) if cfg.history else None for k in ("selection", "final")}
    best, _ = sequential_search(fit_rows, features, cfg.selection_search_trials, cfg.seed,
                                cfg.selection_space, cfg.parallelism, cfg.folds, trials["selection"], cuts)
    decisions = ln.shadow_selection(fit_rows, features, best, cfg.selection_trials, cfg.seed,
                                    parallelism=cfg.parallelism, importance=cfg.selection_importance, cuts=cuts)
    kept = {r["feature"] for r in decisions.where(F.col("decision") != "rejected").collect()}
    if not kept:
        raise ValueError("selection rejected every feature; there is nothing to train on")
    chosen = [f for f in features if f in kept]
    best, means = sequential_search(fit_rows, chosen, cfg.final_search_trials, cfg.seed + 1,
                                    cfg.final_space, cfg.parallelism, cfg.folds, trials["final"], cuts)
    model = ln.fit_model(fit_rows, chosen, best, cfg.seed, cuts)
    iso = ln.calibrate(model, fit_rows, chosen)
    held = ln.score(split.where("holdout"), chosen, model, iso, carry=(ln.LABEL,))
    val = weighted_f1(held, ln.LABEL, "predicted").first()["weighted_f1"]
    report = {"training_date": cfg.training_date or dt.date.today().isoformat(),
              "cross_val_score": float(max(means)), "val_score": float(val or 0.0),
              "model_ver": cfg.model_version, "n_features": len(chosen), "n_candidates": len(features)}
    return Artifacts(chosen, encoders, model, iso, cats, codes, report)


def save(art: Artifacts, path: str) -> None:
    """Persist encoders, model, calibrator and lists (Spark ML formats + JSON)."""
    art.encoders.write().overwrite().save(os.path.join(path, "encoders"))
    art.model.write().overwrite().save(os.path.join(path, "model"))
    art.calibrator.write().overwrite().save(os.path.join(path, "calibrator"))
    meta = {"features": art.features, "categories": art.categories, "codes": art.codes, "report": art.report}
    SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "meta"))


def load(path: str) -> Artifacts:
    meta = json.loads(SparkSession.getActiveSession().read.text(os.path.join(path, "meta")).first()[0])
    return Artifacts(meta["features"], PipelineModel.load(os.path.join(path, "encoders")),
                     GBTClassificationModel.load(os.path.join(path, "model")),
                     IsotonicRegressionModel.load(os.path.join(path, "calibrator")),
                     meta["categories"], meta["codes"], meta["report"])


def append_report(spark: SparkSession, art: Artifacts, path: str, run_id: str | None = None) -> None:
    """Append the training run's row to the metrics table. With ``run_id`` the
    table is one of runs (``sinks.read_runs``) and a repeated run counts once."""
    r = art.report
    row = [(r["training_date"], r["cross_val_score"], r["val_score"], r["model_ver"])]
    report = spark.createDataFrame(row, "training_date string, cross_val_score double, val_score double, "
                                        "model_ver string").coalesce(1)
    if run_id is None:
        write_table(report, path)
    else:
        append_run(report, path, run_id)


def scoring_rows(views: DataFrame, content: DataFrame, category: DataFrame, sentiment: DataFrame,
                 seed_labels: DataFrame, start: str, end: str, sample_size: int, seed: str,
                 zone: str = "America/New_York") -> DataFrame:
    """Rows of sampled visitors in the window, labelled visitors excluded,
    with the article, category and sentiment joins of stage 1."""
    window = views.where(F.col("view_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    sampled = sample_once(window.select("event_id", "visitor_id"), sample_size, seed, "event_id").select("visitor_id")
    return en.raw_rows(views, content, category, sentiment, start, end, exclude=seed_labels, sampled=sampled, zone=zone)


def score_features(features: DataFrame, art: Artifacts) -> DataFrame:
    """Stage 4: one row per visitor, aligned to the training features, scored."""
    # One row per visitor holds by construction (the features are a
    # ``groupBy(visitor)``, the flags left joins to distinct ids), so the
    # source system's de-duplication on the visitor is a no-op here and is
    # not paid for as a wide sort.
    feats = art.encoders.transform(lowercase_columns(features))
    return ln.score(ln.align_features(feats, art.features), art.features, art.model, art.calibrator)


@dataclass
class Sources:
    """The source tables of a run."""
    pageviews: DataFrame
    content: DataFrame
    content_category: DataFrame
    sentiment: DataFrame
    subscriptions: DataFrame
    seed_labels: DataFrame


def run_chain(src: Sources, out_dir: str, start: str, end: str, sample_size: int, sample_seed: str,
              resources: list[str], features: fe.FeatureConfig = fe.FeatureConfig(),
              cfg: TrainConfig = TrainConfig(), run_id: str | None = None, buckets: int | None = None) -> DataFrame:
    """Stages 1 to 5 on one set of sources; the comparison of the labelled
    and the scored visitors. The feature, training and prediction tables and
    the metrics row are stored under ``out_dir``, as are the artifacts; with
    ``run_id`` the row of a repeated run counts once.

    Features, labels, predictions and views by category are stored in
    ``buckets`` by visitor, so their joins need no exchange."""
    spark = src.pageviews.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        write_table(df, os.path.join(out_dir, name), replace=True)
        return spark.read.parquet(os.path.join(out_dir, name))

    n = buckets or bucket_count(spark)

    def by_visitor(df: DataFrame, name: str) -> DataFrame:
        return write_bucketed(df, os.path.join(out_dir, name), "visitor_id", n)

    dims = (src.content, src.content_category, src.sentiment)
    labels = by_visitor(label_rows(src.seed_labels), "labels")
    rows = stored(training_rows(src.pageviews, *dims, src.seed_labels, start, end, features.home_zone), "training_rows")
    feats = by_visitor(visitor_features(rows, src.pageviews, src.subscriptions, resources, features), "features")
    labelled = stored(training_set(feats, labels), "training_set")
    save(train(labelled, cfg), os.path.join(out_dir, "artifacts"))
    art = load(os.path.join(out_dir, "artifacts"))
    append_report(spark, art, os.path.join(out_dir, "metrics"), run_id)
    new = stored(scoring_rows(src.pageviews, *dims, src.seed_labels, start, end, sample_size, sample_seed,
                              features.home_zone), "scoring_rows")
    scores = by_visitor(score_features(visitor_features(new, src.pageviews, src.subscriptions, resources, features), art),
                        "predictions")
    seen = labelled_views(by_visitor(visitor_views(rows), "training_views"), labels)
    found = scored_views(by_visitor(visitor_views(new), "scoring_views"), scores)
    return compare_populations(mix_of_views(seen), mix_of_views(found))


def artifacts_path(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
