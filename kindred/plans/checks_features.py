"""Registered queries of the feature build (cleaning, grains, pivots,
rates, calendar and clock functions, the wide row)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from kindred.functions import calendar as cal
from kindred.functions.text import blank_to_other, clean_name
from kindred.operators import features as fe
from kindred.operators.clean import clean_views, drop_null_content, fill_nulls, top_n
from kindred.plans.catalog import CFG, fixtures, out, register, unpivoted
from kindred.plans.oracle_sql import family_sql, wide_sql, with_features

WF = with_features(CFG)

PV_SQL = ("event_id, visitor_id, piano_id, visit_start, strftime(view_date, '%Y-%m-%d') AS view_date, "
          "page_path, page_views, round(time_on_page, 6) AS time_on_page, content_id, channel, section, "
          "tier1, country, referral_group, device_os, device_category, device_browser, "
          "round(sentiment_score, 6) AS sentiment_score, strftime(publish_date, '%Y-%m-%d') AS publish_date")


def _cleaned(spark, sf):
    return clean_views(fixtures(spark, sf).pageviews)


def _prepared(spark, sf):
    cleaned = _cleaned(spark, sf)
    return fe.prepare(cleaned, fe.Vocabulary.build(cleaned, CFG), CFG)


@register("drop_null_content", f"{WF}\nSELECT {PV_SQL} FROM pageviews WHERE content_id IS NOT NULL")
def q_drop_null_content(spark, sf):
    return out(drop_null_content(fixtures(spark, sf).pageviews))


@register("fill_nulls", f"""{WF}
SELECT event_id, visitor_id, coalesce(piano_id, 'unknown') AS piano_id, coalesce(visit_start, 0) AS visit_start,
  page_path, page_views, round(coalesce(time_on_page, 0.0e0), 6) AS time_on_page,
  coalesce(content_id, 'unknown') AS content_id, coalesce(tier1, 'unknown') AS tier1,
  coalesce(device_browser, 'unknown') AS device_browser,
  round(coalesce(sentiment_score, 0.0e0), 6) AS sentiment_score FROM pageviews""")
def q_fill_nulls(spark, sf):
    pv = fixtures(spark, sf).pageviews.select(
        "event_id", "visitor_id", "piano_id", "visit_start", "page_path", "page_views", "time_on_page",
        "content_id", "tier1", "device_browser", "sentiment_score")
    return out(fill_nulls(pv, 0, "unknown"))


@register("blank_to_other", f"""{WF}
SELECT event_id, CASE WHEN tier1 IS NULL OR regexp_matches(tier1, '^\\s*$') THEN 'other' ELSE tier1 END AS tier1
FROM pageviews""")
def q_blank_to_other(spark, sf):
    pv = fixtures(spark, sf).pageviews
    return pv.select("event_id", blank_to_other("tier1").alias("tier1"))


@register("page_grain", f"{WF}\nSELECT visitor_id, visit_start, page_path, page_views, "
                        "round(time_on_page, 6) AS time_on_page FROM fe_page")
def q_page_grain(spark, sf):
    return out(fe.page_grain(_cleaned(spark, sf)))


@register("session_grain", f"{WF}\nSELECT visitor_id, visit_start, session_pvs, "
                           "round(session_top, 6) AS session_top FROM fe_sess")
def q_session_grain(spark, sf):
    return out(fe.session_grain(fe.page_grain(_cleaned(spark, sf))))


def _stats(spark, sf):
    return fe.session_stats(fe.session_grain(fe.page_grain(_cleaned(spark, sf))))


@register("session_pv_stats", f"{WF}\nSELECT visitor_id, round(session_pvs_mean, 6) AS session_pvs_mean, "
                              "round(session_pvs_median, 6) AS session_pvs_median FROM fe_stats")
def q_session_pv_stats(spark, sf):
    return out(_stats(spark, sf).select("visitor_id", "session_pvs_mean", "session_pvs_median"))


@register("session_time_stats", f"{WF}\nSELECT visitor_id, round(session_top_mean, 6) AS session_top_mean, "
                                "round(session_top_median, 6) AS session_top_median FROM fe_stats")
def q_session_time_stats(spark, sf):
    return out(_stats(spark, sf).select("visitor_id", "session_top_mean", "session_top_median"))


@register("bounce_rate", f"{WF}\nSELECT visitor_id, round(bounce_rate, 6) AS bounce_rate FROM fe_stats")
def q_bounce_rate(spark, sf):
    return out(_stats(spark, sf).select("visitor_id", "bounce_rate"))


@register("content_view_rate", f"{WF}\nSELECT visitor_id, round(content_views_rate, 6) AS content_views_rate "
                               "FROM fe_stats")
def q_content_view_rate(spark, sf):
    rows = _cleaned(spark, sf)
    stats = fe.session_stats(fe.session_grain(fe.page_grain(rows), fe.page_content_map(rows), CFG))
    return out(stats.select("visitor_id", "content_views_rate"))


@register("sentiment_stats", f"""{WF}
SELECT visitor_id, round(fsum(sentiment_score) / count(sentiment_score), 6) AS sentiment_score_mean,
       round(median(sentiment_score), 6) AS sentiment_score_median
FROM fe_prep WHERE visitor_id IS NOT NULL GROUP BY visitor_id""")
def q_sentiment_stats(spark, sf):
    c = _cleaned(spark, sf)
    means = c.where(F.col("visitor_id").isNotNull()).groupBy("visitor_id").agg(
        fe.exact_avg("sentiment_score").alias("sentiment_score_mean"))
    return out(means.join(fe.sentiment_median(c), "visitor_id"))


@register("page_content_map", f"{WF}\nSELECT page_path, content_id, strftime(publish_date, '%Y-%m-%d') "
                              "AS publish_date FROM fe_map")
def q_page_content_map(spark, sf):
    return out(fe.page_content_map(_cleaned(spark, sf)))


@register("join_page_content", f"""{WF}
SELECT p.visitor_id, p.visit_start, p.page_path, p.page_views, round(p.time_on_page, 6) AS time_on_page,
       m.content_id FROM fe_page p LEFT JOIN fe_map m USING (page_path)""")
def q_join_page_content(spark, sf):
    c = _cleaned(spark, sf)
    m = fe.page_content_map(c).select("page_path", "content_id")
    return out(fe.page_grain(c).join(m, "page_path", "left"))


@register("collapse_top_n", f"{WF}\nSELECT event_id, country, channel, section FROM fe_prep")
def q_collapse_top_n(spark, sf):
    prepared = _prepared(spark, sf)
    return prepared.select("event_id", "country", "channel", "section")


def _top_n_sql(col):
    return (f"{WF}\nSELECT {col}, CAST(tot AS BIGINT) AS total_views FROM (SELECT {col}, sum(page_views) AS tot "
            f"FROM fe_base WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY tot DESC, {col} LIMIT {CFG.top_n})")


for _col in ("country", "channel", "section"):
    def _mk(col):
        def q(spark, sf):
            return top_n(_cleaned(spark, sf), col, CFG.top_n)
        return q
    register(f"top_n_{_col}", _top_n_sql(_col))(_mk(_col))


_FAMILIES = {
    "pivot_referral": (fe.REFERRAL, "rf"),
    "pivot_country": (fe.COUNTRY, "ct"),
    "pivot_device_os": (fe.DEVICE_OS, "dos"),
    "pivot_tier1": (fe.TIER1, "t1"),
    "pivot_channel": (fe.CHANNEL, "pc"),
    "pivot_section": (fe.SECTION, "ps"),
    "pivot_business_hours": (fe.BUSINESS_PVS, "bh_pvs"),
    "share_tier1": (fe.TIER1_SHARE, "t1_perc"),
    "top_tier1": (fe.TIER1_TOP, "t1_top"),
    "top_weekpart": (fe.WEEKPART_TOP, "wk_top"),
    "top_business_hours": (fe.BUSINESS_TOP, "bh_top"),
    "top_day_of_week": (fe.DAY_NAME_TOP, "dow_top"),
    "top_day_of_month": (fe.DAY_OF_MONTH_TOP, "dom_top"),
}

WF_INF = with_features(replace(CFG, keep_inf=True))


def _family_query(fam, cfg):
    def q(spark, sf):
        return unpivoted(fe.pivot_family(_prepared(spark, sf), fam, cfg), ["visitor_id"])
    return q


for _name, (_fam, _tag) in _FAMILIES.items():
    register(_name, f"{WF}\n{family_sql(_tag)}")(_family_query(_fam, CFG))
    if _fam.kind == "ratio":
        register(f"{_name}_keep_inf", f"{WF_INF}\n{family_sql(_tag)}")(_family_query(_fam, replace(CFG, keep_inf=True)))


@register("outer_weekpart", f"""{WF}
SELECT visitor_id,
  CAST(coalesce(sum(CASE WHEN weekpart = 'weekday' THEN page_views END), 0) AS DOUBLE) AS weekday_pvs,
  CAST(coalesce(sum(CASE WHEN weekpart = 'weekend' THEN page_views END), 0) AS DOUBLE) AS weekend_pvs
FROM fe_prep WHERE visitor_id IS NOT NULL GROUP BY visitor_id""")
def q_outer_weekpart(spark, sf):
    prepared = _prepared(spark, sf)
    s = lambda part: F.coalesce(F.sum(F.when(F.col("weekpart") == part, F.col("page_views"))),
                                F.lit(0)).cast("double")
    return (prepared.where(F.col("visitor_id").isNotNull()).groupBy("visitor_id")
            .agg(s("weekday").alias("weekday_pvs"), s("weekend").alias("weekend_pvs")))


@register("user_features_wide", f"{WF}\n{wide_sql(CFG)}")
def q_user_features_wide(spark, sf):
    return unpivoted(fe.build_wide(fixtures(spark, sf).pageviews, CFG), ["visitor_id"])


# ---- scalar functions on the cleaned rows -----------------------------------

@register("fn_day_name", f"{WF}\nSELECT event_id, dayname(d) AS day_name FROM fe_prep")
def q_fn_day_name(spark, sf):
    return _cleaned(spark, sf).select("event_id", cal.day_name(cal.parse_date("view_date")).alias("day_name"))


@register("fn_weekpart", f"{WF}\nSELECT event_id, weekpart FROM fe_prep")
def q_fn_weekpart(spark, sf):
    return _cleaned(spark, sf).select("event_id", cal.weekpart(cal.parse_date("view_date")).alias("weekpart"))


@register("fn_day_month", f"{WF}\nSELECT event_id, day(d) AS day_of_month, month(d) AS month FROM fe_prep")
def q_fn_day_month(spark, sf):
    d = cal.parse_date("view_date")
    return _cleaned(spark, sf).select("event_id", F.dayofmonth(d).alias("day_of_month"),
                                      F.month(d).alias("month"))


@register("fn_parse_date", f"""{WF}
SELECT event_id, strftime(TRY_CAST(CAST(view_date AS VARCHAR) AS DATE), '%Y-%m-%d') AS parsed_date,
       strftime(TRY_CAST(page_path AS DATE), '%Y-%m-%d') AS parsed_path FROM pageviews""")
def q_fn_parse_date(spark, sf):
    pv = fixtures(spark, sf).pageviews
    return out(pv.select("event_id", cal.parse_date("view_date").alias("parsed_date"),
                         cal.parse_date("page_path").alias("parsed_path")))


@register("fn_convert_time", f"""{WF}
SELECT event_id, strftime(utc_ts, '%Y-%m-%d %H:%M:%S') AS session_time,
       strftime(TRY_CAST(strftime(utc_ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS session_ts
FROM fe_prep""")
def q_fn_convert_time(spark, sf):
    text = cal.epoch_to_text("visit_start")
    return out(_cleaned(spark, sf).select("event_id", text.alias("session_time"),
                                          cal.text_to_timestamp(text).alias("session_ts")))


@register("fn_local_time", f"""{WF}
SELECT event_id, strftime(timezone('{CFG.home_zone}', timezone('UTC', utc_ts)), '%Y-%m-%d %H:%M:%S') AS est_time
FROM fe_prep""")
def q_fn_local_time(spark, sf):
    return out(_cleaned(spark, sf).select(
        "event_id", cal.to_local(cal.epoch_to_utc("visit_start"), CFG.home_zone).alias("est_time")))


@register("fn_session_hour", f"{WF}\nSELECT event_id, country, session_hour, session_minute FROM fe_prep")
def q_fn_session_hour(spark, sf):
    return _prepared(spark, sf).select("event_id", "country", "session_hour", "session_minute")


@register("fn_business_hours", f"{WF}\nSELECT event_id, session_hour, business_hours FROM fe_prep")
def q_fn_business_hours(spark, sf):
    prepared = _prepared(spark, sf)
    return prepared.select("event_id", "session_hour", "business_hours")


@register("fn_clean_name", f"""{WF}
SELECT DISTINCT tier1, 't1_' || lower(replace(replace(replace(replace(replace(replace(replace(replace(
  CAST(tier1 AS VARCHAR), '(', '_'), ')', ''), ' & ', '_and_'), ' ', '_'), '-', '_'), '''s', ''), '''', ''), '/', ''))
  AS feature_name FROM fe_prep""")
def q_fn_clean_name(spark, sf):
    c = _cleaned(spark, sf)
    return c.select("tier1", F.concat(F.lit("t1_"), clean_name("tier1")).alias("feature_name")).distinct()
