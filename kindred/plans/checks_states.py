"""Registered queries: audience overlap by set sketches, heavy hitters from
bounded states, and loads that count once."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import heavy
from kindred.operators import overlap as ov
from kindred.plans.catalog import W, fixtures, register
from kindred.plans.checks_compare import CM, pred_rows, train_rows
from kindred.sources.session import materialize, scratch_path
from kindred.sources.sinks import append_run, read_runs

# ---- audience overlap ----------------------------------------------------------

LG = 10
SPLIT = "2024-01-11"  # two parts of the window
CLASSES = ["train C-level", "train Non-Clevel", "pred C-level", "pred Non-Clevel"]


def _audience(spark, sf) -> DataFrame:
    """``population, view_date, visitor_id`` of labelled and scored visitors by class."""
    fx = fixtures(spark, sf)
    each = [rows.select(F.concat(F.lit(name + " "), "c_level").alias("population"), "view_date", "visitor_id")
            for name, rows in (("train", train_rows(fx)), ("pred", pred_rows(fx)))]
    return reduce(DataFrame.unionByName, each)


AUDIENCE_SQL = f"""{CM},
au AS (SELECT 'train ' || c_level AS population, view_date, visitor_id FROM cm_train
       UNION ALL SELECT 'pred ' || c_level, view_date, visitor_id FROM cm_pred)"""


@register("audience_sizes", f"""{AUDIENCE_SQL}
SELECT population, strftime(view_date, '%Y-%m-%d') AS view_date, count(DISTINCT visitor_id) AS n, true AS within
FROM au GROUP BY population, view_date""")
def q_audience_sizes(spark, sf):
    """Visitors by class and day, and whether the day's state agrees."""
    rows = _audience(spark, sf)
    keys = ["population", "view_date"]
    exact = rows.groupBy(*keys).agg(F.countDistinct("visitor_id").alias("n"))
    both = ov.states(rows, keys, "visitor_id", LG).join(exact, keys)
    return both.select("population", F.date_format("view_date", "yyyy-MM-dd").alias("view_date"), "n",
                       ov.within(ov.size("state"), "n", "n", LG).alias("within"))


@register("audience_overlap", f"""{AUDIENCE_SQL},
pa AS (SELECT DISTINCT population || CASE WHEN view_date < DATE '{SPLIT}' THEN ' early' ELSE ' late' END AS part, visitor_id
       FROM au WHERE view_date IS NOT NULL AND visitor_id IS NOT NULL),
sz AS (SELECT part, count(*) AS n FROM pa GROUP BY part),
bo AS (SELECT a.part AS l, b.part AS r, count(*) AS n FROM pa a JOIN pa b USING (visitor_id) WHERE a.part < b.part GROUP BY a.part, b.part)
SELECT a.part AS left_part, b.part AS right_part, a.n + b.n - coalesce(bo.n, 0) AS either, coalesce(bo.n, 0) AS "both",
  a.n - coalesce(bo.n, 0) AS left_only, b.n - coalesce(bo.n, 0) AS right_only, true AS within
FROM sz a JOIN sz b ON a.part < b.part LEFT JOIN bo ON bo.l = a.part AND bo.r = b.part""")
def q_audience_overlap(spark, sf):
    """Union, overlap and difference of every two class and half-window
    audiences: day states merged, beside the exact numbers."""
    rows = _audience(spark, sf).where("view_date IS NOT NULL AND visitor_id IS NOT NULL")
    part = F.concat("population", F.when(F.col("view_date") < F.lit(SPLIT).cast("date"), F.lit(" early")).otherwise(F.lit(" late")))
    days = ov.states(rows, ["population", "view_date"], "visitor_id", LG)
    whole = materialize(ov.merge(days.withColumn("part", part), ["part"], LG), "audience")
    # Eight parts, so 28 pairs of states, whatever the data.
    a = whole.select(F.col("part").alias("left_part"), F.col("state").alias("a"))
    b = whole.select(F.col("part").alias("right_part"), F.col("state").alias("b"))
    est = a.join(b, F.col("left_part") < F.col("right_part")).select("left_part", "right_part", *ov.overlap("a", "b", LG))
    # Exact: the set of parts of each visitor, then one row by pair of parts.
    sets = rows.withColumn("part", part).groupBy("visitor_id").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    counts = sets.groupBy("parts").count()
    names = est.select("left_part", "right_part")

    def has(side):
        return F.array_contains("parts", F.col(side))

    def n(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0))

    exact = names.join(F.broadcast(counts), has("left_part") | has("right_part")).groupBy("left_part", "right_part").agg(
        n(F.lit(True)).alias("x_either"), n(has("left_part") & has("right_part")).alias("x_both"),
        n(has("left_part") & ~has("right_part")).alias("x_left_only"), n(~has("left_part") & has("right_part")).alias("x_right_only"))
    cols = ["either", "both", "left_only", "right_only"]
    good = reduce(lambda p, q: p & q, [ov.within(c, "x_" + c, "x_either", LG) for c in cols])
    return est.join(exact, ["left_part", "right_part"]).select(
        "left_part", "right_part", *[F.col("x_" + c).alias(c) for c in cols], good.alias("within"))


# ---- heavy hitters -------------------------------------------------------------

COLUMNS, K, TOP = ["country", "channel", "page_path", "visitor_id"], 20, 5
TOTALS_SQL = f"""{W},
hv AS ({" UNION ALL ".join(f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS category, page_views FROM pageviews" for c in COLUMNS)}),
ht AS (SELECT dimension, category, CAST(sum(page_views) AS BIGINT) AS total FROM hv WHERE category IS NOT NULL GROUP BY dimension, category)"""


@register("heavy_hitters", f"""{TOTALS_SQL}
SELECT dimension, category, total, true AS within FROM ht QUALIFY total * {K + 1} > sum(total) OVER (PARTITION BY dimension)""")
def q_heavy_hitters(spark, sf):
    """Every category above 1 / (k + 1) of the views, its exact sum, and
    whether the state holds it with a weight that its error allows."""
    pv = fixtures(spark, sf).pageviews
    state = heavy.merge(heavy.states(pv, COLUMNS, k=K), K)
    held = state.select("dimension", "error", F.col("total").alias("all"), F.explode("counters").alias("c")) \
        .select("dimension", "error", "all", "c.category", "c.weight")
    each = pv.select("page_views", F.explode(F.array(*[F.struct(
        F.lit(c).alias("dimension"), F.col(c).cast("string").alias("category")) for c in COLUMNS])).alias("e"))
    exact = each.where("e.category IS NOT NULL").groupBy("e.dimension", "e.category").agg(F.sum("page_views").cast("long").alias("total"))
    totals = state.select("dimension", F.col("total").alias("_all"))
    rows = exact.join(totals, "dimension").where(F.col("total") * (K + 1) > F.col("_all")).join(held, ["dimension", "category"], "left")
    ok = F.col("total").between(F.col("weight"), F.col("weight") + F.col("error")) & (F.col("error") * (K + 1) <= F.col("all"))
    return rows.select("dimension", "category", "total", F.coalesce(ok, F.lit(False)).alias("within"))


@register("top_n_from_states", f"""{TOTALS_SQL}
SELECT dimension, category FROM ht QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY total DESC, category) <= {TOP}""")
def q_top_n_from_states(spark, sf):
    """The top categories, from states and exact sums of their candidates."""
    return heavy.top_n(fixtures(spark, sf).pageviews, COLUMNS, TOP, k=K)


# ---- loads that count once -------------------------------------------------------

@register("sink_runs_once", f"{W}\nSELECT * FROM seed_labels UNION ALL SELECT * FROM seed_labels")
def q_sink_runs_once(spark, sf):
    """A table replaced once and appended to by one run, each sent twice."""
    path = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    labels = fixtures(spark, sf).seed_labels
    append_run(labels.where("visitor_id % 2 = 0"), path, "stale")
    for _ in range(2):
        append_run(labels, path, "first", replace=True)
    for _ in range(2):
        append_run(labels, path, "second")
    return read_runs(spark, path)
