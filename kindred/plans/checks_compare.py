"""Registered queries: population comparison (class mix, ranks, top-k,
average time) and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import compare as cm
from kindred.operators import enrich as en
from kindred.operators import features as fe
from kindred.operators import metrics as mt
from kindred.operators.clean import clean_views
from kindred.operators.sample import dedupe
from kindred.plans.catalog import CFG, W, fixtures, out, register
from kindred.plans.oracle_sql import feature_ctes, q

TOP_K = {"channel": 20, "section": 25, "country": 20}


def mix_sql(pop: str) -> str:
    """CTEs ``cm_<pop>_agg``, ``_share`` and ``_mix`` over the rows of ``cm_<pop>``."""
    parts = "\n    UNION ALL ".join(
        f"SELECT c_level, page_views, {q(d)} AS dimension, CAST({d} AS VARCHAR) AS category FROM cm_{pop}"
        for d in cm.DIMENSIONS)
    return f"""
cm_{pop}_agg AS (
  SELECT dimension, category,
    coalesce(sum(CASE WHEN c_level = 'C-level' THEN page_views END), 0) AS c,
    coalesce(sum(CASE WHEN c_level = 'Non-Clevel' THEN page_views END), 0) AS n
  FROM ({parts}) WHERE category IS NOT NULL GROUP BY dimension, category),
cm_{pop}_share AS (
  SELECT dimension, category,
    CASE WHEN sum(c) OVER (PARTITION BY dimension) = 0 THEN 0.0e0
         ELSE c / sum(c) OVER (PARTITION BY dimension) END * 100 AS c_level_share,
    CASE WHEN sum(n) OVER (PARTITION BY dimension) = 0 THEN 0.0e0
         ELSE n / sum(n) OVER (PARTITION BY dimension) END * 100 AS non_c_level_share
  FROM cm_{pop}_agg),
cm_{pop}_mix AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY dimension ORDER BY c_level_share DESC)
         + floor((count(*) OVER (PARTITION BY dimension, c_level_share) - 1) / 2) AS INTEGER) AS c_rank,
    CAST(rank() OVER (PARTITION BY dimension ORDER BY non_c_level_share DESC)
         + floor((count(*) OVER (PARTITION BY dimension, non_c_level_share) - 1) / 2) AS INTEGER) AS nonc_rank
  FROM cm_{pop}_share)"""


CM = f"""{W},
cm_train AS (
  SELECT p.*, CASE WHEN l.management_level = 'C-Level' THEN 'C-level' ELSE 'Non-Clevel' END AS c_level
  FROM pageviews p JOIN seed_labels l USING (visitor_id)),
cm_pred AS (
  SELECT p.*, r.probability, r.predicted,
         CASE WHEN r.predicted = 1 THEN 'C-level' ELSE 'Non-Clevel' END AS c_level
  FROM pageviews p JOIN predictions r USING (visitor_id)),
{mix_sql("train")},
{mix_sql("pred")},
cm_compare AS (
  SELECT t.dimension, t.category,
    t.c_level_share AS c_level_share_train, t.non_c_level_share AS non_c_level_share_train,
    t.c_rank AS c_rank_train, t.nonc_rank AS nonc_rank_train,
    p.c_level_share AS c_level_share_pred, p.non_c_level_share AS non_c_level_share_pred,
    p.c_rank AS c_rank_pred, p.nonc_rank AS nonc_rank_pred
  FROM cm_train_mix t JOIN cm_pred_mix p ON t.dimension = p.dimension AND t.category = p.category)"""

ROUND_MIX = ("round(c_level_share, 6) AS c_level_share, round(non_c_level_share, 6) AS non_c_level_share, "
             "c_rank, nonc_rank")
ROUND_CMP = ("dimension, category, round(c_level_share_train, 6) AS c_level_share_train, "
             "round(non_c_level_share_train, 6) AS non_c_level_share_train, c_rank_train, nonc_rank_train, "
             "round(c_level_share_pred, 6) AS c_level_share_pred, "
             "round(non_c_level_share_pred, 6) AS non_c_level_share_pred, c_rank_pred, nonc_rank_pred")


def train_rows(fx):
    return fx.pageviews.join(fx.seed_labels.select("visitor_id", "management_level"), "visitor_id") \
        .withColumn("c_level", cm.class_from_label())


def pred_rows(fx):
    return fx.pageviews.join(fx.predictions, "visitor_id").withColumn("c_level", cm.class_from_prediction())


@register("join_predictions", f"""{CM}
SELECT event_id, visitor_id, page_views, round(probability, 6) AS probability, predicted FROM cm_pred""")
def q_join_predictions(spark, sf):
    fx = fixtures(spark, sf)
    return out(fx.pageviews.join(fx.predictions, "visitor_id", "inner")
               .select("event_id", "visitor_id", "page_views", "probability", "predicted"))


for _dim in cm.DIMENSIONS:
    def _mk(dim):
        def qf(spark, sf):
            mix = cm.class_mix(train_rows(fixtures(spark, sf)), [dim])
            return out(mix.select(F.col("category").alias(dim), "c_level_share", "non_c_level_share",
                                  "c_rank", "nonc_rank"))
        return qf
    register(f"class_mix_{_dim}", f"{CM}\nSELECT category AS {_dim}, {ROUND_MIX} FROM cm_train_mix "
                                  f"WHERE dimension = {q(_dim)}")(_mk(_dim))


@register("class_mix_all", f"{CM}\nSELECT dimension, category, {ROUND_MIX} FROM cm_train_mix")
def q_class_mix_all(spark, sf):
    return out(cm.class_mix(train_rows(fixtures(spark, sf))))


@register("class_rank", f"""{CM}
SELECT category AS country, c_rank, nonc_rank FROM cm_train_mix WHERE dimension = 'country'""")
def q_class_rank(spark, sf):
    mix = cm.class_mix(train_rows(fixtures(spark, sf)), ["country"])
    return mix.select(F.col("category").alias("country"), "c_rank", "nonc_rank")


def _compare(spark, sf):
    fx = fixtures(spark, sf)
    return cm.compare_populations(cm.class_mix(train_rows(fx)), cm.class_mix(pred_rows(fx)))


@register("compare_populations", f"{CM}\nSELECT {ROUND_CMP} FROM cm_compare")
def q_compare_populations(spark, sf):
    return out(_compare(spark, sf))


_K_SQL = " ".join(f"WHEN {q(d)} THEN {k}" for d, k in TOP_K.items())


@register("compare_top_k", f"""{CM}
SELECT {ROUND_CMP} FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY c_rank_pred, category) AS pos FROM cm_compare)
WHERE pos <= CASE dimension {_K_SQL} ELSE 2147483647 END""")
def q_compare_top_k(spark, sf):
    return out(cm.top_k_by_rank(_compare(spark, sf), TOP_K))


@register("class_avg_time", f"""{CM}
SELECT c_level, round(t.a, 6) AS avg_time_on_page_train, round(p.a, 6) AS avg_time_on_page_pred FROM
 (SELECT c_level, CASE WHEN sum(page_views) = 0 THEN 0.0e0
         ELSE fsum(time_on_page) / sum(page_views) END AS a
  FROM cm_train GROUP BY c_level) t
JOIN
 (SELECT c_level, CASE WHEN sum(page_views) = 0 THEN 0.0e0
         ELSE fsum(time_on_page) / sum(page_views) END AS a
  FROM cm_pred GROUP BY c_level) p USING (c_level)""")
def q_class_avg_time(spark, sf):
    fx = fixtures(spark, sf)
    return out(cm.class_avg_time(train_rows(fx), pred_rows(fx)))


@register("class_time_pivot", f"""{CM}
SELECT round(time_on_page, 6) AS time_on_page,
  CAST(coalesce(sum(CASE WHEN c_level = 'C-level' THEN page_views END), 0) AS BIGINT) AS c_level_pvs,
  CAST(coalesce(sum(CASE WHEN c_level = 'Non-Clevel' THEN page_views END), 0) AS BIGINT) AS non_c_level_pvs
FROM cm_train WHERE time_on_page IS NOT NULL GROUP BY time_on_page""")
def q_class_time_pivot(spark, sf):
    return out(cm.class_time_pivot(train_rows(fixtures(spark, sf))))


# ---- training-set class balance (features of labelled visitors + labels) ----------

_TRAIN_SRC = "(SELECT * FROM pageviews WHERE visitor_id IN (SELECT visitor_id FROM seed_labels))"
TS = f"""{W},
{feature_ctes(CFG, _TRAIN_SRC, "tr_")},
ts_labels AS (
  SELECT visitor_id, c_level FROM (
    SELECT visitor_id, CASE WHEN management_level = 'C-Level' THEN 1 ELSE 0 END AS c_level,
           row_number() OVER (PARTITION BY visitor_id, CASE WHEN management_level = 'C-Level' THEN 1 ELSE 0 END
                              ORDER BY management_level NULLS LAST, user_name NULLS LAST) AS rn
    FROM seed_labels) WHERE rn = 1),
ts AS (SELECT visitor_id, c_level FROM tr_row JOIN tr_stats USING (visitor_id) JOIN ts_labels USING (visitor_id))"""


def training_classes(spark, sf):
    fx = fixtures(spark, sf)
    ids = fe.eligible_visitors(clean_views(en.keep_visitors(fx.pageviews, fx.seed_labels)))
    labels = fx.seed_labels.select(
        "visitor_id", F.when(F.col("management_level") == "C-Level", 1).otherwise(0).alias("c_level"),
        "management_level", "user_name")
    labels = dedupe(labels, ["visitor_id", "c_level"], ["management_level", "user_name"])
    return ids.join(labels, "visitor_id")


@register("class_counts", f"{TS}\nSELECT c_level, count(*) AS n FROM ts GROUP BY c_level")
def q_class_counts(spark, sf):
    return cm.class_counts(training_classes(spark, sf))


@register("class_shares", f"""{TS}
SELECT c_level, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ts GROUP BY c_level""")
def q_class_shares(spark, sf):
    return out(cm.class_shares(training_classes(spark, sf)))


# ---- metrics on predictions with a truth column from customer --------------------

TRUTH = f"""{W},
truth AS (
  SELECT p.visitor_id, CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS y,
         p.probability, p.predicted
  FROM predictions p JOIN customer c ON c.c_custkey = p.visitor_id)"""


def truth(spark, sf):
    fx = fixtures(spark, sf)
    cust = fx.driver_table("customer").select(F.col("c_custkey").alias("visitor_id"), "c_mktsegment")
    return fx.predictions.join(cust, "visitor_id").select(
        "visitor_id", F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("y"),
        "probability", "predicted")


def _fs(expr):
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,12))) AS DOUBLE)"


OVERLAP = (f"SELECT {_fs('y * probability')} AS tp, {_fs('y * (1 - probability)')} AS fn, "
           f"{_fs('(1 - y) * probability')} AS fp, {_fs('y')} AS st, {_fs('probability')} AS sp FROM truth")
TV = "(tp + 1) / (tp + 0.7e0 * fn + (1 - 0.7e0) * fp + 1)"


@register("metric_tversky", f"""{TRUTH}
SELECT round({TV}, 6) AS tversky, round(1 - {TV}, 6) AS tversky_loss FROM ({OVERLAP})""")
def q_metric_tversky(spark, sf):
    return out(mt.tversky(truth(spark, sf), "y", "probability").select("tversky", "tversky_loss"))


@register("metric_focal_tversky", f"""{TRUTH}
SELECT round(pow(1 - {TV}, 0.75e0), 6) AS focal_tversky_loss FROM ({OVERLAP})""")
def q_metric_focal_tversky(spark, sf):
    return out(mt.tversky(truth(spark, sf), "y", "probability").select("focal_tversky_loss"))


@register("metric_dice", f"""{TRUTH}
SELECT round((2 * tp + 1) / (st + sp + 1), 6) AS dice, round(1 - (2 * tp + 1) / (st + sp + 1), 6) AS dice_loss
FROM ({OVERLAP})""")
def q_metric_dice(spark, sf):
    return out(mt.dice(truth(spark, sf), "y", "probability"))


@register("weighted_f1", f"""{TRUTH},
cls AS (SELECT y AS c FROM truth UNION SELECT predicted FROM truth),
per AS (SELECT c, (SELECT count(*) FROM truth WHERE y = c) AS support,
               (SELECT count(*) FROM truth WHERE predicted = c) AS npred,
               (SELECT count(*) FROM truth WHERE y = c AND predicted = c) AS tp FROM cls)
SELECT round(sum(support * CASE WHEN support + npred = 0 THEN 0.0e0 ELSE 2.0e0 * tp / (support + npred) END)
             / sum(support), 6) AS weighted_f1 FROM per""")
def q_weighted_f1(spark, sf):
    return out(mt.weighted_f1(truth(spark, sf), "y", "predicted"))


@register("probability_histogram", f"""{W},
r AS (SELECT min(probability) AS lo, max(probability) AS hi FROM predictions),
c AS (SELECT LEAST(CAST(floor((probability - lo) / (hi - lo) * 10) AS INTEGER), 9) AS bin, count(*) AS n
      FROM predictions, r WHERE probability IS NOT NULL GROUP BY 1)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 10), 6) AS bin_start,
       round(lo + (b.bin + 1) * ((hi - lo) / 10), 6) AS bin_end, coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(10)) b CROSS JOIN r LEFT JOIN c ON c.bin = b.bin""")
def q_probability_histogram(spark, sf):
    return out(mt.histogram(fixtures(spark, sf).predictions, "probability", 10))


@register("class_shares_predicted", f"""{W}
SELECT predicted, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM predictions GROUP BY predicted""")
def q_class_shares_predicted(spark, sf):
    return out(cm.class_shares(fixtures(spark, sf).predictions, "predicted"))
