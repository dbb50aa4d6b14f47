"""Registered queries: scans, sinks, profiles, projections, filters, joins,
latest-per-key, sampling, de-duplication and remaining scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kindred.functions.calendar import publish_date_local
from kindred.functions.text import matches, word_count
from kindred.operators import enrich as en
from kindred.operators import features as fe
from kindred.operators.clean import clean_views
from kindred.operators.sample import dedupe, sample_once, sample_rows
from kindred.plans.catalog import (
    CFG, DATE_END, DATE_START, RESOURCES, SAMPLE_ROWS, SAMPLE_SEED, W, fixtures, out, register, unpivoted)
from kindred.plans.oracle_sql import feature_ctes, q, wide_sql
from kindred.sources import profile
from kindred.sources.session import materialize, scratch_path
from kindred.sources.sinks import read_back, write_table
from kindred.sources.tables import lowercase_columns, read_table, select_except

PV_COLUMNS = ["event_id", "visitor_id", "piano_id", "visit_start", "view_date", "page_path", "page_views",
              "time_on_page", "content_id", "channel", "section", "tier1", "country", "referral_group",
              "device_os", "device_category", "device_browser", "sentiment_score", "publish_date"]
WINDOW_SQL = f"view_date BETWEEN DATE '{DATE_START}' AND DATE '{DATE_END}'"
TYPES_SQL = ", ".join(q(t) for t in en.ARTICLE_TYPES)
RES_SQL = ", ".join(q(r) for r in RESOURCES)
UNSUB = q("(?i)" + en.UNSUBSCRIBE_PATH)
ZONE = CFG.home_zone

# Stage-1 relations restated in SQL: newest rows by NOT EXISTS or a maximum.
STAGE_SQL = f""",
st_sent AS (
  SELECT lower(a.natid) AS sentiment_key, a.pub_date AS scored_on, a.clean_body, a.sentiment_score FROM sentiment a
  WHERE NOT EXISTS (SELECT 1 FROM sentiment b WHERE b.natid = a.natid AND b.pub_date > a.pub_date)),
st_shown AS (SELECT * FROM content WHERE visible AND type IN ({TYPES_SQL})),
st_newest AS (SELECT natural_id, max(version_ts) AS version_ts FROM st_shown GROUP BY natural_id),
st_ct AS (
  SELECT lower(natural_id) AS article_key, CAST(timezone('{ZONE}', timezone('UTC', published_at)) AS DATE) AS publish_date,
         title, body
  FROM st_shown JOIN st_newest USING (natural_id, version_ts)
  GROUP BY 1, timezone('{ZONE}', timezone('UTC', published_at)), title, body),
st_cat AS (
  SELECT DISTINCT category AS tier1, natid AS category_key FROM content_category
  WHERE (natid, ts) IN (SELECT (natid, max(ts)) FROM content_category GROUP BY natid)),
st_content AS (SELECT st_ct.*, tier1 FROM st_ct, st_cat WHERE lower(article_key) = lower(category_key)),
st_views AS (
  SELECT v.* EXCLUDE (tier1, publish_date), c.* FROM pageviews v
  LEFT JOIN st_content c ON c.article_key = lower(v.content_id)),
st_full AS (
  SELECT v.* EXCLUDE (sentiment_score), s.* FROM st_views v
  LEFT JOIN st_sent s ON s.sentiment_key = lower(v.content_id))"""
WS = W + STAGE_SQL


def _fx(spark, sf):
    return fixtures(spark, sf)


def _content_t(fx):
    return en.content_with_category(fx.content, fx.content_category, ZONE)


# ---- A: sources, sinks, profiles ---------------------------------------------

@register("scan_pageviews", f"""{WS}
SELECT event_id, visitor_id, visit_start, strftime(view_date, '%Y-%m-%d') AS view_date, page_path, page_views,
  round(time_on_page, 6) AS time_on_page, content_id, country, channel, section, article_key,
  strftime(publish_date, '%Y-%m-%d') AS publish_date, title, tier1, sentiment_key,
  strftime(scored_on, '%Y-%m-%d') AS scored_on, round(sentiment_score, 6) AS sentiment_score
FROM st_full WHERE {WINDOW_SQL} AND visitor_id IN (SELECT visitor_id FROM seed_labels)""")
def q_scan_pageviews(spark, sf):
    fx = _fx(spark, sf)
    rows = en.raw_rows(fx.pageviews, fx.content, fx.content_category, fx.sentiment,
                       DATE_START, DATE_END, labelled=fx.seed_labels, zone=ZONE)
    return out(rows.select("event_id", "visitor_id", "visit_start", "view_date", "page_path", "page_views",
                           "time_on_page", "content_id", "country", "channel", "section", "article_key",
                           "publish_date", "title", "tier1", "sentiment_key", "scored_on", "sentiment_score"))


@register("attach_text", f"""{WS}
SELECT event_id, article_key, md5(body) AS body_md5, clean_body FROM st_full
WHERE {WINDOW_SQL} AND visitor_id IN (SELECT visitor_id FROM seed_labels)""")
def q_attach_text(spark, sf):
    fx = _fx(spark, sf)
    rows = en.raw_rows(fx.pageviews, fx.content, fx.content_category, fx.sentiment,
                       DATE_START, DATE_END, labelled=fx.seed_labels, zone=ZONE, text=True)
    return rows.select("event_id", "article_key", F.md5("body").alias("body_md5"), "clean_body")


@register("scan_table", "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, "
                        "c_mktsegment FROM customer")
def q_scan_table(spark, sf):
    return out(read_table(spark, "customer", base=sf))


@register("sink_overwrite_roundtrip", f"{W}\nSELECT * FROM seed_labels")
def q_sink_overwrite(spark, sf):
    path = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    labels = _fx(spark, sf).seed_labels
    write_table(labels, path, replace=True)
    write_table(labels, path, replace=True)
    return read_back(spark, path)


@register("sink_append_roundtrip", f"{W}\nSELECT * FROM seed_labels UNION ALL SELECT * FROM seed_labels")
def q_sink_append(spark, sf):
    path = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    labels = _fx(spark, sf).seed_labels
    write_table(labels, path, replace=True)
    write_table(labels, path)
    return read_back(spark, path)


@register("profile_nulls", W + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM pageviews" for c in PV_COLUMNS))
def q_profile_nulls(spark, sf):
    return profile.null_counts(_fx(spark, sf).pageviews.select(*PV_COLUMNS))


@register("profile_shape", f"{W}\nSELECT count(*) AS n_rows, {len(PV_COLUMNS)} AS n_columns FROM pageviews")
def q_profile_shape(spark, sf):
    return profile.shape(_fx(spark, sf).pageviews.select(*PV_COLUMNS))


@register("profile_distinct", f"{W}\nSELECT count(DISTINCT visitor_id) AS n_distinct_visitor_id FROM pageviews")
def q_profile_distinct(spark, sf):
    return profile.distinct_count(_fx(spark, sf).pageviews, "visitor_id")


@register("profile_schema", f"""{W}
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, c AS column_name, t AS type FROM (
  SELECT unnest(['visitor_id', 'user_name', 'management_level']) AS c, unnest(['bigint', 'string', 'string']) AS t)""")
def q_profile_schema(spark, sf):
    return profile.schema(_fx(spark, sf).seed_labels)


@register("preview_rows", f"{W}\nSELECT visitor_id, user_name, management_level FROM seed_labels "
                          "ORDER BY visitor_id, user_name LIMIT 5")
def q_preview_rows(spark, sf):
    return profile.preview(_fx(spark, sf).seed_labels, 5, ["visitor_id", "user_name"])


# ---- B: projections and filters ----------------------------------------------

PROJ = ["visitor_id", "visit_start", "view_date", "page_path", "page_views", "time_on_page", "content_id",
        "device_os", "device_category", "device_browser", "country", "referral_group", "channel", "section"]


@register("project_pageviews", f"""{W}
SELECT visitor_id, visit_start, strftime(view_date, '%Y-%m-%d') AS view_date, page_path, page_views,
  round(time_on_page, 6) AS time_on_page, content_id, device_os, device_category, device_browser, country,
  referral_group, channel, section FROM pageviews""")
def q_project_pageviews(spark, sf):
    return out(_fx(spark, sf).pageviews.select(*PROJ))


@register("project_except", f"{W}\nSELECT * EXCLUDE (user_name) FROM seed_labels")
def q_project_except(spark, sf):
    return select_except(_fx(spark, sf).seed_labels, "user_name")


@register("lowercase_columns", f"""{W}
SELECT visitor_id AS ga_fullvisitorid, page_path AS ga_pagepath, page_views AS ga_pageviews,
  round(time_on_page, 6) AS timeonpage, device_os AS ga_deviceoperatingsystem FROM pageviews""")
def q_lowercase_columns(spark, sf):
    pv = _fx(spark, sf).pageviews.select(
        F.col("visitor_id").alias("GA_fullVisitorId"), F.col("page_path").alias("GA_pagePath"),
        F.col("page_views").alias("GA_pageViews"), F.col("time_on_page").alias("timeOnPage"),
        F.col("device_os").alias("GA_deviceOperatingSystem"))
    return out(lowercase_columns(pv))


@register("drop_columns", f"""{W}
SELECT visitor_id, page_path, page_views, round(time_on_page, 6) AS time_on_page, content_id FROM pageviews""")
def q_drop_columns(spark, sf):
    pv = _fx(spark, sf).pageviews.select("event_id", "visitor_id", "piano_id", "page_path", "page_views",
                                         "time_on_page", "content_id")
    return out(pv.drop("event_id", "piano_id"))


@register("filter_date_range", f"""{W}
SELECT event_id, visitor_id, strftime(view_date, '%Y-%m-%d') AS view_date FROM pageviews WHERE {WINDOW_SQL}""")
def q_filter_date_range(spark, sf):
    pv = _fx(spark, sf).pageviews
    return out(pv.where(F.col("view_date").between(F.lit(DATE_START).cast("date"), F.lit(DATE_END).cast("date")))
               .select("event_id", "visitor_id", "view_date"))


@register("filter_visible_types", f"""{W}
SELECT natural_id, title, type, strftime(version_ts, '%Y-%m-%d %H:%M:%S') AS version_ts FROM content
WHERE visible AND type IN ({TYPES_SQL})""")
def q_filter_visible_types(spark, sf):
    return out(en.filter_articles(_fx(spark, sf).content).select("natural_id", "title", "type", "version_ts"))


@register("filter_active_subs", f"""{W}
SELECT user_id_uid, resource_id, status, round(total_refunded, 6) AS total_refunded FROM subscriptions
WHERE resource_id IN ({RES_SQL}) AND status = 'active' AND total_refunded < 1""")
def q_filter_active_subs(spark, sf):
    s = _fx(spark, sf).subscriptions
    return out(s.where(F.col("resource_id").isin(RESOURCES) & (F.col("status") == "active")
                       & (F.col("total_refunded") < 1)))


@register("filter_path_regex", f"""{W}
SELECT event_id, visitor_id, page_path FROM pageviews WHERE regexp_matches(page_path, {UNSUB})""")
def q_filter_path_regex(spark, sf):
    pv = _fx(spark, sf).pageviews
    return pv.where(matches("page_path", en.UNSUBSCRIBE_PATH, case_sensitive=False)).select(
        "event_id", "visitor_id", "page_path")


# ---- C / E: joins and latest-per-key ------------------------------------------

@register("latest_sentiment", f"""{WS}
SELECT sentiment_key, strftime(scored_on, '%Y-%m-%d') AS scored_on, clean_body,
       round(sentiment_score, 6) AS sentiment_score FROM st_sent""")
def q_latest_sentiment(spark, sf):
    return out(en.latest_sentiment(_fx(spark, sf).sentiment))


@register("latest_content", f"""{WS}
SELECT article_key, strftime(publish_date, '%Y-%m-%d') AS publish_date, title, md5(body) AS body_md5 FROM st_ct""")
def q_latest_content(spark, sf):
    c = en.latest_content(_fx(spark, sf).content, ZONE)
    return out(c.select("article_key", "publish_date", "title", F.md5("body").alias("body_md5")))


@register("latest_category", f"{WS}\nSELECT tier1, category_key FROM st_cat")
def q_latest_category(spark, sf):
    return en.latest_category(_fx(spark, sf).content_category)


@register("join_content_category", f"""{WS}
SELECT article_key, strftime(publish_date, '%Y-%m-%d') AS publish_date, title, md5(body) AS body_md5, tier1
FROM st_content""")
def q_join_content_category(spark, sf):
    c = _content_t(_fx(spark, sf))
    return out(c.select("article_key", "publish_date", "title", F.md5("body").alias("body_md5"), "tier1"))


@register("join_views_content", f"""{WS}
SELECT event_id, visitor_id, content_id, article_key, strftime(publish_date, '%Y-%m-%d') AS publish_date,
       title, tier1 FROM st_views""")
def q_join_views_content(spark, sf):
    fx = _fx(spark, sf)
    j = en.join_content(fx.pageviews, materialize(_content_t(fx), "content"))
    return out(j.select("event_id", "visitor_id", "content_id", "article_key", "publish_date", "title", "tier1"))


@register("join_views_sentiment", f"""{WS}
SELECT event_id, visitor_id, content_id, article_key, tier1, sentiment_key,
       strftime(scored_on, '%Y-%m-%d') AS scored_on, clean_body, round(sentiment_score, 6) AS sentiment_score
FROM st_full""")
def q_join_views_sentiment(spark, sf):
    fx = _fx(spark, sf)
    j = en.join_sentiment(en.join_content(fx.pageviews, materialize(_content_t(fx), "content")),
                          materialize(en.latest_sentiment(fx.sentiment), "sentiment"))
    return out(j.select("event_id", "visitor_id", "content_id", "article_key", "tier1", "sentiment_key",
                        "scored_on", "clean_body", "sentiment_score"))


@register("semi_labelled", f"""{W}
SELECT event_id, visitor_id FROM pageviews WHERE visitor_id IN (SELECT visitor_id FROM seed_labels)""")
def q_semi_labelled(spark, sf):
    fx = _fx(spark, sf)
    return en.keep_visitors(fx.pageviews, fx.seed_labels).select("event_id", "visitor_id")


SAMPLE_SQL = (f"SELECT visitor_id FROM pageviews WHERE {WINDOW_SQL} "
              f"ORDER BY md5(CAST(event_id AS VARCHAR) || '|{SAMPLE_SEED}') LIMIT {SAMPLE_ROWS}")


def _sample(fx):
    window = fx.pageviews.where(
        F.col("view_date").between(F.lit(DATE_START).cast("date"), F.lit(DATE_END).cast("date")))
    return sample_rows(window, SAMPLE_ROWS, SAMPLE_SEED, "event_id").select("visitor_id")


@register("sample_visitors", f"{W}\nSELECT DISTINCT visitor_id FROM ({SAMPLE_SQL})")
def q_sample_visitors(spark, sf):
    return _sample(_fx(spark, sf)).distinct()


@register("sample_visitors_once", f"{W}\nSELECT DISTINCT visitor_id FROM ({SAMPLE_SQL})")
def q_sample_visitors_once(spark, sf):
    """The same visitors from a bounded state, made in one scan of the window."""
    window = _fx(spark, sf).pageviews.where(
        F.col("view_date").between(F.lit(DATE_START).cast("date"), F.lit(DATE_END).cast("date")))
    return sample_once(window.select("event_id", "visitor_id"), SAMPLE_ROWS, SAMPLE_SEED).select("visitor_id").distinct()


@register("semi_sampled", f"""{W}
SELECT event_id, visitor_id FROM pageviews WHERE {WINDOW_SQL} AND visitor_id IN ({SAMPLE_SQL})""")
def q_semi_sampled(spark, sf):
    fx = _fx(spark, sf)
    window = fx.pageviews.where(
        F.col("view_date").between(F.lit(DATE_START).cast("date"), F.lit(DATE_END).cast("date")))
    return en.keep_visitors(window, _sample(fx)).select("event_id", "visitor_id")


@register("anti_labelled", f"""{W}
SELECT event_id, visitor_id FROM pageviews WHERE visitor_id NOT IN (SELECT visitor_id FROM seed_labels)""")
def q_anti_labelled(spark, sf):
    fx = _fx(spark, sf)
    return en.drop_visitors_not_in(fx.pageviews, fx.seed_labels).select("event_id", "visitor_id")


@register("anti_null_aware", f"""{W}
SELECT event_id, visitor_id FROM pageviews WHERE visitor_id NOT IN (
  SELECT CASE WHEN management_level IS NOT NULL THEN visitor_id END FROM seed_labels)""")
def q_anti_null_aware(spark, sf):
    fx = _fx(spark, sf)
    ids = fx.seed_labels.select(
        F.when(F.col("management_level").isNotNull(), F.col("visitor_id")).alias("visitor_id"))
    return en.drop_visitors_not_in(fx.pageviews, ids).select("event_id", "visitor_id")


@register("join_labels_using", f"""{W},
{feature_ctes(CFG)}
SELECT w.visitor_id, l.management_level, w.feature, w.value
FROM ({wide_sql(CFG)}) w JOIN seed_labels l ON l.visitor_id = w.visitor_id""")
def q_join_labels_using(spark, sf):
    fx = _fx(spark, sf)
    wide = fe.build_wide(fx.pageviews, CFG)
    return unpivoted(wide.join(fx.seed_labels, "visitor_id").drop("user_name"), ["visitor_id", "management_level"])


SUBS_SQL = (f"SELECT visitor_id FROM pageviews WHERE lower(piano_id) IN (SELECT lower(user_id_uid) FROM subscriptions "
            f"WHERE resource_id IN ({RES_SQL}) AND status = 'active' AND total_refunded < 1) GROUP BY visitor_id")


@register("subscriber_ids", f"{W}\n{SUBS_SQL}")
def q_subscriber_ids(spark, sf):
    fx = _fx(spark, sf)
    return en.active_subscriber_ids(fx.subscriptions, fx.pageviews, RESOURCES)


@register("flag_newsletter", f"""{W}
SELECT v.visitor_id, CASE WHEN u.visitor_id IS NOT NULL THEN 'nl_unsubscriber' ELSE 'nl_subscriber' END
  AS nl_subscription
FROM (SELECT DISTINCT visitor_id FROM pageviews) v
LEFT JOIN (SELECT DISTINCT visitor_id FROM pageviews WHERE regexp_matches(page_path, {UNSUB})) u
  ON u.visitor_id = v.visitor_id""")
def q_flag_newsletter(spark, sf):
    pv = _fx(spark, sf).pageviews
    return en.membership_flag(pv.select("visitor_id").distinct(), en.unsubscriber_ids(pv),
                              "nl_subscription", "nl_unsubscriber", "nl_subscriber")


@register("flag_subscriber", f"""{W}
SELECT DISTINCT visitor_id, CASE WHEN visitor_id IN ({SUBS_SQL}) THEN 'subscriber' ELSE 'non_subscriber' END
  AS subscriber FROM pageviews""")
def q_flag_subscriber(spark, sf):
    fx = _fx(spark, sf)
    ids = en.active_subscriber_ids(fx.subscriptions, fx.pageviews, RESOURCES)
    return en.membership_flag(fx.pageviews.select("visitor_id").distinct(), ids,
                              "subscriber", "subscriber", "non_subscriber")


# ---- align features of the scoring population to the training list --------------

_TRAIN_SRC = "(SELECT * FROM pageviews WHERE visitor_id IN (SELECT visitor_id FROM seed_labels))"
_SCORE_SRC = "(SELECT * FROM pageviews WHERE visitor_id NOT IN (SELECT visitor_id FROM seed_labels))"


@register("align_features", f"""{W},
{feature_ctes(CFG, _TRAIN_SRC, "tr_")},
{feature_ctes(CFG, _SCORE_SRC, "sc_")}
{wide_sql(CFG, "sc_", "SELECT DISTINCT f FROM tr_long WHERE fam <> 'bh_pvs'")}""")
def q_align_features(spark, sf):
    fx = _fx(spark, sf)
    rows = clean_views(en.keep_visitors(fx.pageviews, fx.seed_labels))
    names = fe.feature_names(fe.prepare(rows, fe.Vocabulary.build(rows, CFG), CFG))
    return unpivoted(fe.build_wide(en.drop_visitors_not_in(fx.pageviews, fx.seed_labels), CFG, names=names),
                     ["visitor_id"])


# ---- D17 / D18: distinct and de-duplication -----------------------------------

@register("distinct_content", f"{W}\nSELECT DISTINCT lower(natural_id) AS natid, type, visible FROM content")
def q_distinct_content(spark, sf):
    c = _fx(spark, sf).content
    return c.select(F.lower("natural_id").alias("natid"), "type", "visible").distinct()


@register("dedupe_visitor_class", f"""{W}
SELECT visitor_id, c_level, management_level, user_name FROM (
  SELECT visitor_id, CASE WHEN management_level = 'C-Level' THEN 1 ELSE 0 END AS c_level, management_level,
         user_name, row_number() OVER (PARTITION BY visitor_id, CASE WHEN management_level = 'C-Level'
         THEN 1 ELSE 0 END ORDER BY management_level NULLS LAST, user_name NULLS LAST) AS rn
  FROM seed_labels) WHERE rn = 1""")
def q_dedupe_visitor_class(spark, sf):
    lab = _fx(spark, sf).seed_labels.select(
        "visitor_id", F.when(F.col("management_level") == "C-Level", 1).otherwise(0).alias("c_level"),
        "management_level", "user_name")
    return dedupe(lab, ["visitor_id", "c_level"], ["management_level", "user_name"])


@register("dedupe_visitor", f"""{W}
SELECT visitor_id, event_id, page_path, strftime(view_date, '%Y-%m-%d') AS view_date FROM (
  SELECT *, row_number() OVER (PARTITION BY visitor_id ORDER BY event_id) AS rn FROM pageviews) WHERE rn = 1""")
def q_dedupe_visitor(spark, sf):
    pv = _fx(spark, sf).pageviews.select("visitor_id", "event_id", "page_path", "view_date")
    return out(dedupe(pv, ["visitor_id"], ["event_id"]))


# ---- H: remaining scalar functions ------------------------------------------------

@register("fn_lower", f"{W}\nSELECT natural_id, lower(natural_id) AS natid FROM content")
def q_fn_lower(spark, sf):
    return _fx(spark, sf).content.select("natural_id", F.lower("natural_id").alias("natid"))


@register("fn_regex_flags", f"""{W}
SELECT event_id, coalesce(regexp_matches(page_path, {UNSUB}), false) AS is_unsubscribe,
       coalesce(regexp_matches(content_id, {q(CFG.content_pattern)}), false) AS is_content FROM pageviews""")
def q_fn_regex_flags(spark, sf):
    pv = _fx(spark, sf).pageviews
    return pv.select("event_id",
                     matches("page_path", en.UNSUBSCRIBE_PATH, case_sensitive=False).alias("is_unsubscribe"),
                     matches("content_id", CFG.content_pattern).alias("is_content"))


@register("fn_publish_date", f"""{W}
SELECT natural_id, title, strftime(CAST(timezone('{ZONE}', timezone('UTC', published_at)) AS DATE), '%Y-%m-%d')
  AS publish_date FROM content""")
def q_fn_publish_date(spark, sf):
    c = _fx(spark, sf).content
    return out(c.select("natural_id", "title", publish_date_local("published_at", ZONE).alias("publish_date")))


@register("fn_word_count", r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS BIGINT)
  AS n_words FROM documents""")
def q_fn_word_count(spark, sf):
    docs = read_table(spark, "documents", base=sf)
    return docs.select("doc_id", word_count("text").cast("long").alias("n_words"))


@register("flag_c_level", f"""{W}
SELECT visitor_id, management_level, CASE WHEN management_level = 'C-Level' THEN 1 ELSE 0 END AS c_level
FROM seed_labels""")
def q_flag_c_level(spark, sf):
    lab = _fx(spark, sf).seed_labels
    return lab.select("visitor_id", "management_level",
                      F.when(F.col("management_level") == "C-Level", 1).otherwise(0).alias("c_level"))



# ---- end to end: stage-1 rows -> wide features + flags ------------------------------

_STAGE1_SRC = (f"(SELECT * FROM st_full WHERE {WINDOW_SQL} "
               f"AND visitor_id IN (SELECT visitor_id FROM seed_labels))")


@register("training_features", f"""{WS},
{feature_ctes(CFG, _STAGE1_SRC, "tf_")},
unsub AS (SELECT visitor_id FROM {_STAGE1_SRC} WHERE regexp_matches(page_path, {UNSUB})),
subs AS ({SUBS_SQL})
SELECT visitor_id, feature, value,
  CASE WHEN visitor_id IN (SELECT visitor_id FROM unsub) THEN 'nl_unsubscriber' ELSE 'nl_subscriber' END AS nl_subscription,
  CASE WHEN visitor_id IN (SELECT visitor_id FROM subs) THEN 'subscriber' ELSE 'non_subscriber' END AS subscriber
FROM ({wide_sql(CFG, "tf_")})""")
def q_training_features(spark, sf):
    from kindred.plans import stages as st
    fx = _fx(spark, sf)
    rows = materialize(st.training_rows(fx.pageviews, fx.content, fx.content_category, fx.sentiment,
                                        fx.seed_labels, DATE_START, DATE_END, ZONE), "training-rows")
    return unpivoted(st.visitor_features(rows, fx.pageviews, fx.subscriptions, RESOURCES, CFG),
                     ["visitor_id", "nl_subscription", "subscriber"])
