"""Registered queries of the moving window and the mergeable sketches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import features as fe
from kindred.operators import quantiles as qt
from kindred.operators import rolling as ro
from kindred.operators.clean import clean_views
from kindred.plans.catalog import CFG, W, fixtures, out, register, unpivoted
from kindred.plans.oracle_sql import feature_ctes, wide_sql
from kindred.plans.stages import artifacts_path

# Two weeks, moved twice: by three days, and by four.
WINDOWS = [("2024-01-01", "2024-01-14"), ("2024-01-04", "2024-01-17"), ("2024-01-08", "2024-01-21")]

_ROOTS: dict = {}


def _root(spark, sf) -> str:
    """Day partials and the states of all windows, the first one built and
    the others moved to; once per session and scale."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ROOTS:
        root = artifacts_path(spark, "rolling")
        ro.write_days(fixtures(spark, sf).pageviews, root, CFG)
        ro.open_window(spark, root, *WINDOWS[0])
        for old, new in zip(WINDOWS, WINDOWS[1:]):
            ro.move_window(spark, root, old, new)
        _ROOTS[key] = root
    return _ROOTS[key]


def _in(window) -> str:
    return f"(SELECT * FROM pageviews WHERE view_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}')"


ROLLING_SQL = W + "".join(f",\n{feature_ctes(CFG, _in(w), f'w{i}_')}" for i, w in enumerate(WINDOWS)) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{w[1]}' AS window_end, visitor_id, feature, value FROM ({wide_sql(CFG, f'w{i}_')})" for i, w in enumerate(WINDOWS))


@register("features_rolling", ROLLING_SQL)
def q_features_rolling(spark, sf):
    """The wide row at three positions of a moving window, from merged states."""
    root = _root(spark, sf)
    each = [unpivoted(ro.window_features(spark, root, *w, CFG), ["visitor_id"]).withColumn("window_end", F.lit(w[1])) for w in WINDOWS]
    return reduce(DataFrame.unionByName, each).select("window_end", "visitor_id", "feature", "value")


@register("rolling_window_state", f"""{W},
{feature_ctes(CFG, _in(WINDOWS[2]))}
SELECT 'country' AS dimension, country AS category, count(*) AS n, CAST(sum(page_views) AS BIGINT) AS views,
       round(fsum(time_on_page), 6) AS time FROM fe_base GROUP BY country
UNION ALL SELECT 'day_of_month', CAST(day(view_date) AS VARCHAR), count(*), CAST(sum(page_views) AS BIGINT),
       round(fsum(time_on_page), 6) FROM fe_base GROUP BY day(view_date)
UNION ALL SELECT 'tier1', tier1, count(*), CAST(sum(page_views) AS BIGINT), round(fsum(time_on_page), 6)
       FROM fe_base GROUP BY tier1""")
def q_window_state(spark, sf):
    """Totals by category of the twice moved state: what was added and taken away."""
    state = ro.window_state(spark, _root(spark, sf), *WINDOWS[2])["cats"].where(F.col("column").isin("country", "day_of_month", "tier1"))
    return out(state.groupBy(F.col("column").alias("dimension"), F.col("raw").alias("category"))
               .agg(F.sum("n").alias("n"), F.sum("views").cast("long").alias("views"), F.sum("time").cast("double").alias("time")))


# The stated bound holds in 99 of 100 cases; the check takes twice as much,
# which a sketch misses about once in ten million.
K, PARTS = 100, 20
SLACK = 2 * qt.rank_error(K)
LOW, HIGH = round(0.5 - SLACK, 6), round(0.5 + SLACK, 6)


def _measures(spark, sf) -> DataFrame:
    """``measure, visitor_id, value``: session views and time, and scores."""
    rows = clean_views(fixtures(spark, sf).pageviews)
    sess = fe.session_grain(fe.page_grain(rows))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                               for c in ("session_pvs", "session_top")])).alias("e")
    scores = rows.where("visitor_id IS NOT NULL").select(F.lit("sentiment_score").alias("measure"), "visitor_id",
                                                         F.col("sentiment_score").alias("value"))
    return sess.select("visitor_id", each).select("e.measure", "visitor_id", "e.value").unionByName(scores)


def _sketch_sql(key: str) -> str:
    low, high = LOW, HIGH
    return f"""{W},
{feature_ctes(CFG)},
m AS (SELECT 'session_pvs' AS measure, visitor_id, CAST(session_pvs AS DOUBLE) AS value FROM fe_sess
      UNION ALL SELECT 'session_top', visitor_id, session_top FROM fe_sess
      UNION ALL SELECT 'sentiment_score', visitor_id, sentiment_score FROM fe_base WHERE visitor_id IS NOT NULL),
r AS (SELECT measure, {key} AS visitor_id, value, row_number() OVER (PARTITION BY measure, {key} ORDER BY value) AS rn,
             count(*) OVER (PARTITION BY measure, {key}) AS n FROM m WHERE value IS NOT NULL)
SELECT measure, visitor_id, any_value(n) AS n, round(min(CASE WHEN rn >= greatest(1.0e0, n * {low}e0) THEN value END), 6) AS low,
       round(min(CASE WHEN rn >= greatest(1.0e0, n * {high}e0) THEN value END), 6) AS high, true AS within
FROM r GROUP BY measure, visitor_id"""


def _checked(rows: DataFrame) -> DataFrame:
    """Medians of states merged from ``PARTS`` parts of the data, beside the
    exact values at the ends of the allowed ranks."""
    keys = ["measure", "visitor_id"]
    parts = qt.states(rows.withColumn("part", F.pmod(F.xxhash64("measure", "visitor_id", "value"), F.lit(PARTS))), [*keys, "part"], "value", K)
    whole = qt.merge(parts, keys, K).withColumn("median", qt.quantile("state", 0.5))
    both = whole.join(qt.exact_bounds(rows, keys, "value", LOW, HIGH), keys)
    return out(both.select(*keys, "n", "low", "high", F.col("median").between(F.col("low"), F.col("high")).alias("within")))


@register("sketch_medians", _sketch_sql("0"))
def q_sketch_medians(spark, sf):
    """Medians over all visitors from states of 20 parts, within the rank bound."""
    return _checked(_measures(spark, sf).withColumn("visitor_id", F.lit(0)))


@register("sketch_medians_by_visitor", _sketch_sql("visitor_id"))
def q_sketch_medians_by_visitor(spark, sf):
    """The same by visitor."""
    return _checked(_measures(spark, sf))
