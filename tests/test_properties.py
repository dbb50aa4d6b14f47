"""Invariants: partitioning and distributed ranking do not change results."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.operators import features as fe
from kindred.operators.learn import rank_by_hash, stratify
from kindred.operators.sample import row_hash, sample_rows
from kindred.sources.fixtures import Fixtures
from conftest import SF001


def _wide_rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_partitioning_does_not_change_features(spark):
    pv = Fixtures(spark, SF001).pageviews
    base, other = fe.build_wide(pv), fe.build_wide(pv.repartition(7))
    assert base.columns == other.columns
    assert _wide_rows(base) == _wide_rows(other)


def test_shares_sum_to_one_and_rates_in_range(spark):
    wide = fe.build_wide(Fixtures(spark, SF001).pageviews)
    share_cols = [c for c in wide.columns if c.endswith("_perc_pvs")]
    for r in wide.select(sum(F.col(fe.quoted(c)) for c in share_cols).alias("s"), "bounce_rate",
                         "content_views_rate").collect():
        assert abs(r["s"] - 1.0) < 1e-9 or r["s"] == 0.0
        assert 0.0 <= r["bounce_rate"] <= 1.0 and 0.0 <= r["content_views_rate"] <= 1.0


def test_rank_by_hash_equals_row_number(spark):
    df = spark.range(3000).withColumn("g", (F.col("id") % 3).cast("int")) \
        .withColumn("h", row_hash("id", "s"))
    got = rank_by_hash(df, "g", "h").select("id", "_rn")
    want = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("h")).alias("_rn"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stratify_exact_quotas_and_disjoint_folds(spark):
    df = spark.range(1003).select(F.col("id").alias("visitor_id"),
                                  (F.col("id") % 4 == 0).cast("int").alias("c_level"))
    s = stratify(df, seed=7).cache()
    counts = {(r[0], r[1]): r[2] for r in s.groupBy("c_level", "holdout").count().collect()}
    n1 = df.where("c_level = 1").count()
    n0 = 1003 - n1
    assert counts[(1, True)] == -(-n1 // 10) and counts[(0, True)] == -(-n0 // 10)
    assert s.count() == 1003 and s.select("visitor_id").distinct().count() == 1003
    folds = s.where(~F.col("holdout")).groupBy("c_level", "fold").count().collect()
    for cls in (0, 1):
        sizes = [r["count"] for r in folds if r["c_level"] == cls]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_sample_rows_equals_brute_force(spark):
    df = spark.range(20000).select(F.col("id").alias("event_id"), (F.col("id") % 97).alias("v"))
    got = sample_rows(df, 300, "42").select("event_id")
    want = df.orderBy(row_hash("event_id", "42")).limit(300).select("event_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    assert sample_rows(df.limit(10), 300, "42").count() == 10


def test_dates_are_session_zone_independent(spark):
    from kindred.functions.calendar import epoch_to_text
    ts = int(dt.datetime(2024, 3, 10, 7, 30, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(ts,)], "s long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(epoch_to_text("s")).first()[0] == "2024-03-10 07:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fused_wide_equals_join_of_families(spark):
    """The fused one-aggregate build equals the source system's shape: one
    frame per family, session and sentiment statistics, inner-joined."""
    from functools import reduce
    from kindred.operators.clean import clean_views
    pv = Fixtures(spark, SF001).pageviews
    cfg = fe.FeatureConfig(home_country="NATION_19")
    cleaned = clean_views(pv)
    voc = fe.Vocabulary.build(cleaned, cfg)
    prepared = fe.prepare(cleaned, voc, cfg)
    frames = [fe.session_stats(fe.session_grain(fe.page_grain(prepared), fe.page_content_map(prepared), cfg)),
              prepared.groupBy("visitor_id").agg(
                  (fe.exact_sum("sentiment_score") / F.count("sentiment_score")).alias("sentiment_score_mean"),
                  F.median("sentiment_score").alias("sentiment_score_median"))]
    frames += [fe.pivot_family(prepared, fam, cfg)
               for fam in fe.HEAD_FAMILIES + fe.TAIL_FAMILIES]
    joined = reduce(lambda a, b: a.join(b, "visitor_id", "inner"), frames)
    wide = fe.build_wide(pv, cfg, voc)
    assert sorted(joined.columns) == sorted(wide.columns)
    assert _wide_rows(joined.select(*map(fe.quoted, wide.columns))) == _wide_rows(wide)


def test_approx_median_option_runs_and_is_close(spark):
    pv = Fixtures(spark, SF001).pageviews
    exact = {r["visitor_id"]: r for r in fe.build_wide(pv).collect()}
    approx = {r["visitor_id"]: r for r in fe.build_wide(pv, fe.FeatureConfig(approx_median=True)).collect()}
    assert set(exact) == set(approx)
    for v, r in exact.items():
        assert approx[v]["session_pvs_mean"] == r["session_pvs_mean"]
        assert abs(approx[v]["sentiment_score_median"] - r["sentiment_score_median"]) <= 1.0


def test_equal_rows_of_a_hot_visitor_are_combined_before_the_shuffle(spark):
    """A bot: a third of all rows belong to one visitor and are equal. Each
    task sends one row for them, however many it has read."""
    from kindred.operators.clean import clean_views
    rows = Fixtures(spark, SF001).pageviews.where("content_id IS NOT NULL").limit(1).drop("visitor_id")
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("visitor_id")).crossJoin(rows)
    cleaned = clean_views(df)
    prepared = fe.prepare(cleaned, fe.Vocabulary.build(cleaned))
    long = fe.long_features(prepared, (fe.TIER1,))
    assert {r["visitor_id"]: r["value"] for r in long.collect()}[0] == 10000 * rows.first()["page_views"]
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum(page_views") > plan.index("Exchange hashpartitioning(visitor_id")
