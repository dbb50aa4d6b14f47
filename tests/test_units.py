"""Literal unit tests for the semantic traps (expected values computed by hand)."""

import datetime as dt
import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from kindred.functions.calendar import business_hours, weekpart
from kindred.functions.text import clean_name, clean_name_str
from kindred.operators import features as fe
from kindred.operators.compare import average_rank_desc
from kindred.operators.enrich import drop_visitors_not_in, latest_per_key

VIEW_SCHEMA = ("event_id long, visitor_id long, visit_start long, view_date date, page_path string, "
               "page_views int, time_on_page double, content_id string, channel string, section string, "
               "tier1 string, country string, referral_group string, device_os string, "
               "sentiment_score double, publish_date date")


def view(i, v, vs, path, pv, t, **kw):
    base = dict(event_id=i, visitor_id=v, visit_start=vs, view_date=dt.date(2024, 1, 1), page_path=path,
                page_views=pv, time_on_page=t, content_id="blogandpostid_1", channel="c", section="s",
                tier1="T", country="X", referral_group="R", device_os="OS", sentiment_score=1.0,
                publish_date=dt.date(2024, 1, 1))
    base.update(kw)
    return tuple(base[k] for k in [f.split()[0] for f in VIEW_SCHEMA.split(", ")])


def test_clean_name():
    assert clean_name_str("Arts & Culture (Men's)/Top-10") == "arts_and_culture__mentop_10"
    assert clean_name_str(7) == "7"


def test_clean_name_column_matches_driver_side(spark):
    vals = ["Arts & Culture (Men's)/Top-10", "a b", "a-b", "Plain"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r[0]: r[1] for r in df.select("v", clean_name("v")).collect()}
    assert got == {v: clean_name_str(v) for v in vals}


def test_bounce_and_session_time(spark):
    rows = [view(1, 1, 100, "/a", 1, 10.0), view(2, 1, 200, "/a", 1, 20.0),
            view(3, 1, 300, "/a", 3, 5.0), view(4, 1, 300, "/b", 0, 7.0)]
    df = spark.createDataFrame(rows, VIEW_SCHEMA)
    stats = fe.session_stats(fe.session_grain(fe.page_grain(df))).first()
    assert abs(stats["bounce_rate"] - 2 / 3) < 1e-12
    # session 300: pages /a (3 views, 5s) and /b (0 views, 7s) -> mean page time 6
    sess = {r["visit_start"]: r for r in fe.session_grain(fe.page_grain(df)).collect()}
    assert sess[300]["session_pvs"] == 3 and sess[300]["session_top"] == 6.0


def test_page_to_session_time(spark):
    rows = [view(1, 1, 100, "/a", 1, 4.0), view(2, 1, 100, "/a", 2, 6.0), view(3, 1, 100, "/b", 1, 20.0)]
    df = spark.createDataFrame(rows, VIEW_SCHEMA)
    s = fe.session_grain(fe.page_grain(df)).first()
    assert s["session_top"] == 15.0 and s["session_pvs"] == 3


def test_ratio_zero_policy(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 5.0), (2, 5.0)], "n long, t double")
    got = [r[0] for r in df.select(fe.ratio(F.col("t"), F.col("n"))).collect()]
    assert got == [0.0, 0.0, 2.5]
    inf = [r[0] for r in df.select(fe.ratio(F.col("t"), F.col("n"), keep_inf=True)).collect()]
    assert inf[0] == 0.0 and math.isinf(inf[1]) and inf[2] == 2.5


def test_weekpart_and_business_hours(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6), 7), (dt.date(2024, 1, 8), 8), (None, 17),
                                (dt.date(2024, 1, 7), 18), (dt.date(2024, 1, 9), None)], "d date, h int")
    got = [(r[0], r[1]) for r in df.select(weekpart("d"), business_hours("h")).collect()]
    assert got == [("weekend", "non_business_hours"), ("weekday", "business_hours"),
                   ("weekday", "business_hours"), ("weekend", "non_business_hours"),
                   ("weekday", "non_business_hours")]


def test_average_rank(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 3.0), ("d", 1.0), ("e", 1.0), ("f", 1.0)],
                               "k string, v double").withColumn("g", F.lit(1))
    got = {r[0]: r[1] for r in df.select("k", average_rank_desc("v", ["g"])).collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "d": 5, "e": 5, "f": 5}


def test_rank_ties_kept(spark):
    df = spark.createDataFrame([("x", 2, "v1"), ("x", 2, "v2"), ("x", 1, "v0"), ("y", 1, "w")],
                               "k string, ts int, v string")
    got = sorted(r["v"] for r in latest_per_key(df, "k", "ts").collect())
    assert got == ["v1", "v2", "w"]


def test_not_in_with_null_gives_no_rows(spark):
    views = spark.createDataFrame([(1,), (2,), (None,)], "visitor_id long")
    ids = spark.createDataFrame([(1,), (None,)], "visitor_id long")
    assert drop_visitors_not_in(views, ids).count() == 0
    ids2 = spark.createDataFrame([(1,)], "visitor_id long")
    assert [r[0] for r in drop_visitors_not_in(views, ids2).collect()] == [2]
    empty = ids2.limit(0)
    assert drop_visitors_not_in(views, empty).count() == 3


def test_name_collision_sums_and_null_category_visitor_dropped(spark):
    rows = [view(1, 1, 100, "/a", 2, 4.0, tier1="a b"), view(2, 1, 100, "/b", 3, 6.0, tier1="a-b"),
            view(3, 2, 100, "/a", 1, 1.0, device_os=None)]
    wide = fe.build_wide(spark.createDataFrame(rows, VIEW_SCHEMA))
    cols = wide.columns
    assert cols.count("t1_a_b") == 1
    out = {r["visitor_id"]: r for r in wide.collect()}
    assert set(out) == {1}  # visitor 2 has no device OS on any row
    assert out[1]["t1_a_b"] == 5.0 and out[1]["t1_a_b_perc_pvs"] == 1.0
    assert abs(out[1]["t1_a_b_top"] - 2.0) < 1e-12


def test_null_date_is_weekday_and_has_no_day_column(spark):
    rows = [view(1, 1, 100, "/a", 1, 4.0), view(2, 1, 100, "/b", 1, 6.0, view_date=None)]
    wide = fe.build_wide(spark.createDataFrame(rows, VIEW_SCHEMA))
    r = wide.first()
    assert r["weekday_top"] == 5.0
    assert [c for c in wide.columns if c.startswith("day_of_mon_")] == ["day_of_mon_1_top"]


def test_top_n_collapse_and_other(spark):
    rows = [view(i, 1, 100, f"/p{i}", 1, 1.0, country=f"C{i % 4}") for i in range(12)]
    cfg = fe.FeatureConfig(top_n=2)
    wide = fe.build_wide(spark.createDataFrame(rows, VIEW_SCHEMA), cfg)
    ct = sorted(c for c in wide.columns if c.startswith("ct_"))
    assert ct == ["ct_c0", "ct_c1", "ct_other"]
    r = wide.first()
    assert (r["ct_c0"], r["ct_c1"], r["ct_other"]) == (3.0, 3.0, 6.0)


def test_home_country_hour(spark):
    # 2024-01-01 13:30 UTC = 08:30 in New York
    ts = int(dt.datetime(2024, 1, 1, 13, 30, tzinfo=dt.timezone.utc).timestamp())
    rows = [view(1, 1, ts, "/a", 1, 1.0, country="united states"), view(2, 2, ts, "/a", 1, 1.0)]
    df = spark.createDataFrame(rows, VIEW_SCHEMA)
    from kindred.operators.clean import clean_views
    voc = fe.Vocabulary.build(clean_views(df))
    got = {r["visitor_id"]: r["session_hour"] for r in fe.prepare(clean_views(df), voc).collect()}
    assert got == {1: 8, 2: 13}


def test_rows_are_plain_tuples():
    assert Row(a=1).a == 1


def test_large_domains_have_no_limit(spark):
    from kindred.operators.clean import clean_views
    rows = [view(i, i % 50, 100, "/a", 1, 1.0, tier1=f"Cat {i}") for i in range(20_000)]
    cleaned = clean_views(spark.createDataFrame(rows, VIEW_SCHEMA))
    long = fe.long_features(fe.prepare(cleaned, fe.Vocabulary.build(cleaned)), (fe.TIER1, fe.TIER1_SHARE))
    got = long.groupBy("family").agg(F.count("*").alias("n"), F.sum("value").alias("v")).collect()
    assert {r["family"]: (r["n"], round(r["v"], 6)) for r in got} == {0: (20_000, 20_000.0), 1: (20_000, 50.0)}


def test_wide_columns_stand_in_family_and_category_order(spark):
    rows = [view(1, 1, 100, "/a", 2, 4.0, tier1="b", view_date=dt.date(2024, 1, 10)),
            view(2, 1, 100, "/b", 3, 6.0, tier1="a", view_date=dt.date(2024, 1, 2))]
    wide = fe.build_wide(spark.createDataFrame(rows, VIEW_SCHEMA))
    assert wide.columns == [
        "visitor_id", "session_pvs_mean", "session_pvs_median", "session_top_mean", "session_top_median",
        "sentiment_score_mean", "sentiment_score_median", "rf_r", "ct_x", "dos_os", "t1_a", "t1_b",
        "t1_a_perc_pvs", "t1_b_perc_pvs", "pc_c", "ps_s_pvs", "t1_a_top", "t1_b_top", "bounce_rate",
        "content_views_rate", "weekday_top", "non_business_hours_top", "tuesday_top", "wednesday_top",
        "day_of_mon_2_top", "day_of_mon_10_top"]


def test_keep_inf_through_wide_build(spark):
    rows = [view(1, 1, 100, "/a", 0, 5.0, tier1="Z"), view(2, 1, 100, "/b", 2, 4.0, tier1="Y")]
    df = spark.createDataFrame(rows, VIEW_SCHEMA)
    finite = fe.build_wide(df).first()
    inf = fe.build_wide(df, fe.FeatureConfig(keep_inf=True)).first()
    assert finite["t1_z_top"] == 0.0 and math.isinf(inf["t1_z_top"])
    assert finite["t1_y_top"] == inf["t1_y_top"] == 2.0


def test_size_partitions(spark):
    from kindred.sources.session import size_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    old_split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_partitions(spark, 100 << 40, cores=8000) == (100 << 40) // (256 << 20)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_partitions(spark, 1 << 20, cores=4) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_adv)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_split)
