"""Registered queries of the learning stage. SQL cannot fit a model; the
oracles state what must hold of its output: which rows there are, and that
probabilities, decisions, scores and reports agree with each other."""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.operators import enrich as en
from kindred.operators import features as fe
from kindred.operators import learn as ln
from kindred.operators import trees as tr
from kindred.operators.search import propose, sequential_search, stored_trials, to_params
from kindred.plans import stages as st
from kindred.plans.catalog import (
    CFG, DATE_END, DATE_START, RESOURCES, SAMPLE_ROWS, SAMPLE_SEED, W, fixtures, out, register)
from kindred.plans.checks_compare import TS, mix_sql, training_classes
from kindred.plans.checks_sources import RES_SQL, SAMPLE_SQL, STAGE_SQL, UNSUB, WINDOW_SQL
from kindred.plans.oracle_sql import feature_ctes
from kindred.sources.session import materialize

SEED = 4222
# The registered checks search small trees, few times; every range is one of
# ``SearchSpace`` and every draw is used as drawn. The stage defaults are the
# source system's 10 / 100 / 60 trials over its full ranges.
SPACE = ln.SearchSpace(max_iter=(2, 6), max_depth=(2, 4), step_size=(0.05, 1.0))
QUICK = st.TrainConfig(seed=SEED, selection_search_trials=3, selection_trials=20, final_search_trials=3,
                       selection_space=SPACE, final_space=SPACE, parallelism=4, selection_importance="gain", training_date="2024-02-01")
BASE = ln.TreeParams(max_iter=4, step_size=0.3, max_depth=3)


FLAGS_SQL = f"""{W},
unsub AS (SELECT visitor_id FROM pageviews WHERE regexp_matches(page_path, {UNSUB})),
paying AS (SELECT lower(user_id_uid) AS uid FROM subscriptions
           WHERE resource_id IN ({RES_SQL}) AND status = 'active' AND total_refunded < 1),
fl AS (SELECT visitor_id,
         CASE WHEN visitor_id IN (SELECT visitor_id FROM unsub) THEN 'nl_unsubscriber' ELSE 'nl_subscriber' END
           AS nl_subscription,
         CASE WHEN bool_or(coalesce(lower(piano_id) IN (SELECT uid FROM paying), false)) THEN 'subscriber'
              ELSE 'non_subscriber' END AS subscriber
       FROM pageviews GROUP BY visitor_id)"""


@register("encode_categories", f"""{FLAGS_SQL}
SELECT visitor_id, CAST(dense_rank() OVER (ORDER BY nl_subscription) - 1 AS INTEGER) AS nl_subscription_code,
       CAST(dense_rank() OVER (ORDER BY subscriber) - 1 AS INTEGER) AS subscriber_code FROM fl""")
def q_encode_categories(spark, sf):
    fx = fixtures(spark, sf)
    visitors = fx.pageviews.select("visitor_id").distinct()
    flags = en.add_flags(visitors, fx.pageviews, fx.subscriptions, fx.pageviews, RESOURCES)
    out_df = flags
    for ix in ln.category_encoder(["nl_subscription", "subscriber"]):
        out_df = ix.fit(flags).transform(out_df)
    return out_df.select("visitor_id", F.col("nl_subscription_code").cast("int").alias("nl_subscription_code"),
                         F.col("subscriber_code").cast("int").alias("subscriber_code"))


SPLIT_SQL = f"""{TS},
ts_r AS (SELECT visitor_id, c_level, md5(CAST(visitor_id AS VARCHAR) || '|{SEED}') AS h,
                row_number() OVER (PARTITION BY c_level ORDER BY md5(CAST(visitor_id AS VARCHAR) || '|{SEED}')) AS rn
         FROM ts),
ts_s AS (SELECT visitor_id, c_level, h, (rn - 1) % 10 = 0 AS holdout FROM ts_r),
ts_f AS (SELECT visitor_id, c_level, CAST((row_number() OVER (PARTITION BY c_level ORDER BY h) - 1) % 5 AS INTEGER)
                AS fold FROM ts_s WHERE NOT holdout)"""


def _split(spark, sf):
    return ln.stratify(training_classes(spark, sf).select("visitor_id", "c_level"), seed=SEED)


@register("stratified_holdout", f"{SPLIT_SQL}\nSELECT visitor_id, c_level, holdout FROM ts_s")
def q_stratified_holdout(spark, sf):
    return _split(spark, sf).select("visitor_id", "c_level", "holdout")


@register("stratified_folds", f"{SPLIT_SQL}\nSELECT visitor_id, c_level, fold FROM ts_f")
def q_stratified_folds(spark, sf):
    return _split(spark, sf).where(~F.col("holdout")).select("visitor_id", "c_level", "fold")


_PREPARED: dict = {}


def _prepared_train(spark, sf):
    """Encoded, split and stored training rows; built once per session and
    scale and shared by the learning checks."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        fx = fixtures(spark, sf)
        rows = en.keep_visitors(fx.pageviews, fx.seed_labels)
        feats = st.visitor_features(rows, fx.pageviews, fx.subscriptions, RESOURCES, CFG)
        ts = materialize(st.training_set(feats, fx.seed_labels).drop("management_level").na.fill(0), "check-train")
        cats = ln.string_columns(ts)
        enc = ts
        for m in [ix.fit(ts) for ix in ln.category_encoder(cats)]:
            enc = m.transform(enc)
        features = [c for c in ts.columns if c not in cats + ["visitor_id", "c_level"]] + [f"{c}_code" for c in cats]
        split = materialize(ln.stratify(enc, seed=SEED), "check-split")
        _PREPARED[key] = (split.where(~F.col("holdout")), features)
    return _PREPARED[key]


_STRINGS = ["piano_id", "page_path", "content_id", "channel", "section", "tier1", "country", "referral_group",
            "device_os", "device_category", "device_browser"]


@register("columns_by_type", W + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM pageviews" for c in _STRINGS))
def q_columns_by_type(spark, sf):
    """The string columns of the page views, with their distinct values."""
    views = fixtures(spark, sf).pageviews
    names = ln.string_columns(views)
    return views.agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "column_name", "n_distinct")


@register("split_predictors_target", f"""{SPLIT_SQL}
SELECT visitor_id, c_level AS target, (SELECT count(DISTINCT f) FROM tr_long WHERE fam <> 'bh_pvs') + 10 AS n_predictors
FROM ts_f""")
def q_split_predictors_target(spark, sf):
    """Label and number of assembled predictors of each training row."""
    train, features = _prepared_train(spark, sf)
    rows = ln.assemble(train, features, "visitor_id", F.col("c_level").alias("target"))
    return rows.select("visitor_id", "target", F.size(vector_to_array("features")).cast("long").alias("n_predictors"))


def _in_range(c):
    return (F.col(c) >= 0) & (F.col(c) <= 1)


@register("train_gbt", f"""{SPLIT_SQL}
SELECT visitor_id, c_level, true AS probability_in_range, true AS predicted_agrees FROM ts_f""")
def q_train_gbt(spark, sf):
    train, features = _prepared_train(spark, sf)
    model = ln.fit_model(train, features, BASE, SEED)
    pred = ln.positive_probability(model.transform(ln.assemble(train, features, "visitor_id", "c_level")))
    return pred.select("visitor_id", "c_level", _in_range("p1").alias("probability_in_range"),
                       ((F.col("prediction") == 1) == (F.col("p1") > 0.5)).alias("predicted_agrees"))


@register("cross_validate", f"""{SPLIT_SQL}
SELECT fold, count(*) AS n_rows, 3 AS n_candidates, true AS means_in_range, true AS best_is_largest
FROM ts_f GROUP BY fold""")
def q_cross_validate(spark, sf):
    train, features = _prepared_train(spark, sf)
    cands = [BASE, ln.TreeParams(max_iter=2, step_size=0.1, max_depth=2), ln.TreeParams(max_iter=3, max_depth=4, pos_weight=3)]
    best, means = ln.cross_validate(train, features, cands, SEED, parallelism=4)
    return train.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "fold", "n_rows", F.lit(len(means)).alias("n_candidates"),
        F.lit(all(0 <= m <= 1 for m in means)).alias("means_in_range"),
        F.lit(means[cands.index(best)] == max(means)).alias("best_is_largest"))


@register("random_search", f"""{SPLIT_SQL}
SELECT CAST(t.range AS INTEGER) AS trial, (SELECT count(*) FROM ts_f) AS n_rows, true AS drawn_in_space,
       true AS mean_in_range FROM range(4) t""")
def q_random_search(spark, sf):
    train, features = _prepared_train(spark, sf)
    cands = ln.draw_params(4, SEED, SPACE)
    _, means = ln.cross_validate(train, features, cands, SEED, parallelism=4)
    inside = [SPACE.max_iter[0] <= p.max_iter <= SPACE.max_iter[1] and SPACE.max_depth[0] <= p.max_depth <= SPACE.max_depth[1]
              and SPACE.step_size[0] <= p.step_size <= SPACE.step_size[1] for p in cands]
    rows = [(i, ok, 0.0 <= m <= 1.0) for i, (ok, m) in enumerate(zip(inside, means))]
    return spark.createDataFrame(rows, "trial int, drawn_in_space boolean, mean_in_range boolean").withColumn(
        "n_rows", F.lit(train.count()).cast("long"))


_FIXED = ", ".join(f"('{c}')" for c in [*fe.SESSION_COLUMNS, *fe.SENTIMENT_COLUMNS, "bounce_rate", "content_views_rate",
                                          "nl_subscription_code", "subscriber_code"])


@register("shadow_feature_selection", f"""{TS}
SELECT feature, true AS hits_in_range, true AS decision_agrees, true AS some_accepted, true AS some_rejected
FROM (SELECT DISTINCT f AS feature FROM tr_long WHERE fam <> 'bh_pvs' UNION ALL SELECT * FROM (VALUES {_FIXED}))""")
def q_shadow_selection(spark, sf):
    train, features = _prepared_train(spark, sf)
    trials = 20
    found = materialize(ln.shadow_selection(train, features, BASE, trials=trials, seed=SEED), "check-selection")
    lo, hi = ln.binomial_bounds(trials, 0.05 / len(features))
    want = F.when(F.col("hits") >= hi, "accepted").when(F.col("hits") <= lo, "rejected").otherwise("tentative")
    all_rows = Window.partitionBy()
    return found.select("feature", F.col("hits").between(0, trials).alias("hits_in_range"),
                        (F.col("decision") == want).alias("decision_agrees"),
                        F.max(F.col("decision") == "accepted").over(all_rows).alias("some_accepted"),
                        F.max(F.col("decision") == "rejected").over(all_rows).alias("some_rejected"))


@register("calibrate_isotonic", f"""{SPLIT_SQL}
SELECT visitor_id, true AS probability_in_range, true AS predicted_agrees, true AS rises_with_raw FROM ts_f""")
def q_calibrate_isotonic(spark, sf):
    train, features = _prepared_train(spark, sf)
    model = ln.fit_model(train, features, BASE, SEED)
    scored = ln.score(train, features, model, ln.calibrate(model, train, features))
    return scored.join(rises(scored), "raw").select("visitor_id", _in_range("probability").alias("probability_in_range"),
                         ((F.col("predicted") == 1) == (F.col("probability") > 0.5)).alias("predicted_agrees"),
                         "rises_with_raw")


def rises(scored, ranges: int = 1024):
    """``raw, rises_with_raw``: whether a distinct score has one probability,
    and none before it a larger one. Scores are compared inside ``ranges``
    ranges, and each with the largest of the ranges before it."""
    groups = materialize(scored.groupBy("raw").agg(F.min("probability").alias("low"), F.max("probability").alias("high"))
                         .withColumn("at", F.floor(F.col("raw") * ranges)), "check-scores")
    inside = F.lag("high").over(Window.partitionBy("at").orderBy("raw"))
    whole = groups.groupBy("at").agg(F.max("high").alias("top"))  # at most ``ranges`` + 1 rows
    before = whole.select("at", F.max("top").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    return groups.withColumn("inside", inside).join(F.broadcast(before), "at").select(
        "raw", ((F.col("low") == F.col("high")) & (F.col("low") >= F.coalesce(F.greatest("inside", "before"), F.lit(0.0)))).alias("rises_with_raw"))


@register("calibrate_score_groups", f"""{SPLIT_SQL}
SELECT c_level, count(*) AS n, true AS fewer_groups_than_rows, true AS same_as_on_rows FROM ts_f GROUP BY c_level""")
def q_score_groups(spark, sf):
    """The calibrator fitted on distinct scores against the one fitted on rows."""
    train, features = _prepared_train(spark, sf)
    p = materialize(ln.positive_probability(fitted(spark, sf).transform(
        ln.assemble(ln.with_label_weight(train, 1), features, "label", "c_level"))).select("p1", "label", "c_level"), "check-scored")
    rows = IsotonicRegression(featuresCol="p1", labelCol="label", predictionCol="on_rows").fit(p.select("p1", "label"))
    groups = ln.score_groups(p)
    iso = IsotonicRegression(featuresCol="p1", labelCol="label", weightCol="weight", predictionCol="on_groups").fit(groups)
    fewer = groups.count() < p.count()
    return iso.transform(rows.transform(p)).groupBy("c_level").agg(
        F.count(F.lit(1)).alias("n"), F.lit(fewer).alias("fewer_groups_than_rows"),
        (F.max(F.abs(F.col("on_rows") - F.col("on_groups"))) < 1e-9).alias("same_as_on_rows"))


_FITTED: dict = {}


def fitted(spark, sf):
    """One small model for the checks that only read it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        train, features = _prepared_train(spark, sf)
        _FITTED[key] = ln.fit_model(train, features, BASE, SEED)
    return _FITTED[key]


@register("shapley_contributions", f"""{SPLIT_SQL}
SELECT visitor_id, true AS adds_up_to_margin FROM ts_f""")
def q_shapley(spark, sf):
    """Every training row: its features' Shapley values and the base make its margin."""
    train, features = _prepared_train(spark, sf)
    model = fitted(spark, sf)
    data = ln.assemble(train, features, "visitor_id")
    phi = tr.contributions(data, model).groupBy("visitor_id").agg(F.sum("phi").alias("phi"))
    raw = model.transform(data).select("visitor_id", vector_to_array("rawPrediction")[1].alias("raw"))
    base = tr.base_value(model)
    return raw.join(phi, "visitor_id", "left").select("visitor_id", (F.abs(
        F.coalesce("phi", F.lit(0.0)) + F.lit(base) - F.col("raw")) < 1e-9).alias("adds_up_to_margin"))


@register("leaf_regularisation", f"""{SPLIT_SQL}
SELECT CAST(t.range AS INTEGER) AS tree, (SELECT count(*) FROM ts_f) AS n_rows,
       (SELECT CAST(sum(CASE WHEN c_level = 1 THEN {BASE.pos_weight} ELSE 1 END) AS DOUBLE) FROM ts_f) AS weight,
       true AS unregularised_at_zero, true AS shrunk FROM range({BASE.max_iter}) t""")
def q_leaf_regularisation(spark, sf):
    """Leaf sums of every tree; values at 0 / 0 and with L1 and L2."""
    train, features = _prepared_train(spark, sf)
    model = fitted(spark, sf)
    data = ln.assemble(ln.with_label_weight(train, BASE.pos_weight), features, "label", "weight")
    paths = tr.leaves(model)
    sums = materialize(tr.leaf_sums(data, model, paths=paths), "check-leaves")
    own = spark.createDataFrame([(p.tree, p.leaf, p.value) for p in paths], "tree int, leaf int, own double")
    both = tr.regularised(sums).select("tree", "leaf", "n", "weight", F.col("value").alias("zero")) \
        .join(tr.regularised(sums, l2=1.0, l1=0.5).select("tree", "leaf", F.col("value").alias("some")), ["tree", "leaf"]) \
        .join(own, ["tree", "leaf"])
    return both.groupBy("tree").agg(
        F.sum("n").alias("n_rows"), F.sum("weight").alias("weight"),
        (F.max(F.abs(F.col("zero") - F.col("own"))) < 1e-9).alias("unregularised_at_zero"),
        F.bool_and((F.abs("some") < F.abs("zero")) | (F.col("zero") == 0)).alias("shrunk"))


@register("sequential_search", f"""{SPLIT_SQL}
SELECT CAST(t.range AS INTEGER) AS trial, (SELECT count(*) FROM ts_f) AS n_rows, true AS drawn_in_space,
       true AS mean_in_range, true AS resumes FROM range(4) t""")
def q_sequential_search(spark, sf):
    """A search stopped after two trials and taken up again from its history."""
    train, features = _prepared_train(spark, sf)
    path = st.artifacts_path(spark, "trials")
    sequential_search(train, features, 2, SEED, SPACE, parallelism=2, path=path)
    first = {t.number: t for t in stored_trials(spark, path)}
    _, means = sequential_search(train, features, 4, SEED, SPACE, parallelism=2, path=path)
    rows = []
    for t in stored_trials(spark, path):
        p = to_params(t.point, SPACE)
        inside = (SPACE.max_iter[0] <= p.max_iter <= SPACE.max_iter[1] and SPACE.max_depth[0] <= p.max_depth <= SPACE.max_depth[1]
                  and SPACE.step_size[0] <= p.step_size <= SPACE.step_size[1])
        again = propose([x for x in stored_trials(spark, path) if x.number < t.number // 2 * 2], t.number, SEED) == t.point
        rows.append((t.number, inside, 0.0 <= means[t.number] <= 1.0, again and first.get(t.number, t) == t))
    return spark.createDataFrame(rows, "trial int, drawn_in_space boolean, mean_in_range boolean, resumes boolean").withColumn(
        "n_rows", F.lit(train.count()).cast("long"))


_CHAIN: dict = {}


def _chain(spark, sf):
    """Stages 1 to 5 once per session and scale: the folder of the stored
    tables, and the comparison."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CHAIN:
        fx = fixtures(spark, sf)
        src = st.Sources(fx.pageviews, fx.content, fx.content_category, fx.sentiment, fx.subscriptions, fx.seed_labels)
        path = st.artifacts_path(spark, "chain")
        done = st.run_chain(src, path, DATE_START, DATE_END, SAMPLE_ROWS, SAMPLE_SEED, RESOURCES, CFG, QUICK)
        _CHAIN[key] = (path, materialize(done, "comparison"))
    return _CHAIN[key]


@register("training_report", """SELECT '2024-02-01' AS training_date, 'kindred-1' AS model_ver, 1 AS n_rows,
  true AS cross_val_in_range, true AS val_score_recomputed""")
def q_training_report(spark, sf):
    """The stored metrics row; its hold-out F1 again from the scored rows."""
    path, _ = _chain(spark, sf)
    art = st.load(os.path.join(path, "artifacts"))
    data = spark.read.parquet(os.path.join(path, "training_set")).drop("management_level").na.fill(0)
    split = ln.stratify(art.encoders.transform(data), seed=QUICK.seed, holdout_every=QUICK.holdout_every, folds=QUICK.folds)
    held = ln.score(split.where("holdout"), art.features, art.model, art.calibrator, carry=("c_level",))
    held.createOrReplaceTempView("_held")
    f1 = spark.sql("""SELECT sum(n * f1) / sum(n) AS again FROM (
      SELECT c, count_if(c_level = c) AS n, 2 * count_if(c_level = c AND predicted = c)
             / (count_if(c_level = c) + count_if(predicted = c)) AS f1
      FROM _held, (SELECT c_level AS c FROM _held UNION SELECT predicted FROM _held) GROUP BY c)""").first()["again"]
    rows = spark.read.parquet(os.path.join(path, "metrics"))
    return rows.withColumn("again", F.lit(f1)).select(
        "training_date", "model_ver", F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("n_rows"),
        _in_range("cross_val_score").alias("cross_val_in_range"),
        (F.abs(F.col("val_score") - F.col("again")) < 1e-9).alias("val_score_recomputed"))


_NEW_SRC = (f"(SELECT * FROM st_full WHERE {WINDOW_SQL} AND visitor_id NOT IN (SELECT visitor_id FROM seed_labels) "
            f"AND visitor_id IN ({SAMPLE_SQL}))")
_CHAIN_SQL = f"""{W}{STAGE_SQL},
{feature_ctes(CFG, _NEW_SRC, "nw_")},
new_ids AS (SELECT visitor_id FROM nw_row WHERE visitor_id IN (SELECT visitor_id FROM nw_stats))"""


@register("score_visitors", f"""{_CHAIN_SQL}
SELECT visitor_id, true AS probability_in_range, true AS predicted_agrees FROM new_ids""")
def q_score_visitors(spark, sf):
    path, _ = _chain(spark, sf)
    return spark.read.parquet(os.path.join(path, "predictions")).select(
        "visitor_id", _in_range("probability").alias("probability_in_range"),
        ((F.col("predicted") == 1) == (F.col("probability") > 0.5)).alias("predicted_agrees"))


@register("score_to_compare", f"""{_CHAIN_SQL},
cm_train AS (
  SELECT p.*, CASE WHEN l.management_level = 'C-Level' THEN 'C-level' ELSE 'Non-Clevel' END AS c_level
  FROM st_full p JOIN seed_labels l USING (visitor_id) WHERE {WINDOW_SQL}),
cm_pred AS (SELECT *, 'Non-Clevel' AS c_level FROM st_full p
            WHERE {WINDOW_SQL} AND visitor_id IN (SELECT visitor_id FROM new_ids)),
{mix_sql("train")},
{mix_sql("pred")}
SELECT t.dimension, t.category, round(t.c_level_share, 6) AS c_level_share_train,
       round(t.non_c_level_share, 6) AS non_c_level_share_train, t.c_rank AS c_rank_train, t.nonc_rank AS nonc_rank_train,
       true AS scored_shares_in_range
FROM cm_train_mix t JOIN cm_pred_mix p ON t.dimension = p.dimension AND t.category = p.category""")
def q_score_to_compare(spark, sf):
    """Stages 1 to 5: labelled visitors against those the engine scored."""
    _, done = _chain(spark, sf)
    ok = [F.col(c).between(-1e-9, 100 + 1e-9) for c in ("c_level_share_pred", "non_c_level_share_pred")]
    return out(done.select("dimension", "category", "c_level_share_train", "non_c_level_share_train", "c_rank_train",
                           "nonc_rank_train", (ok[0] & ok[1]).alias("scored_shares_in_range")))
