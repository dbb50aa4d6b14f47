"""DuckDB text of the feature chain, used by the oracle queries.

It restates the feature rules in plain SQL, in long form: one row for each
visitor and feature, absent features as 0.
"""

from __future__ import annotations

from kindred.operators.features import FeatureConfig
from kindred.sources.fixtures import duckdb_with_clause

# The name rules and the blank test, stated here apart from the engine's.
NAME_STEPS = [("(", "_"), (")", ""), (" & ", "_and_"), (" ", "_"), ("-", "_"), ("'s", ""), ("'", ""), ("/", "")]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(expr: str) -> str:
    out = f"CAST({expr} AS VARCHAR)"
    for old, new in NAME_STEPS:
        out = f"replace({out}, {q(old)}, {q(new)})"
    return f"lower({out})"


def feature_ctes(cfg: FeatureConfig, source: str = "pageviews", prefix: str = "fe_") -> str:
    """CTEs ``fe_base fe_tops fe_prep fe_page fe_map fe_sess fe_stats fe_row fe_long``
    over the rows of ``source`` (names carry ``prefix`` instead of ``fe_``)."""
    return _feature_ctes(cfg).replace("FROM pageviews WHERE", f"FROM {source} WHERE").replace("fe_", prefix)


def _feature_ctes(cfg: FeatureConfig) -> str:
    top_union = "\n      UNION ALL ".join(
        f"SELECT {q(c)} AS dim, {c} AS cat, sum(page_views) AS tot FROM fe_base "
        f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cfg.collapse_columns)
    collapse = ",\n     ".join(
        f"CASE WHEN {c} IN (SELECT cat FROM fe_tops WHERE dim = {q(c)}) THEN {c} "
        f"ELSE {q(cfg.other)} END AS {c}" for c in cfg.collapse_columns)
    home = q(cfg.home_country)
    zero = ("WHEN fsum(time_on_page) > 0 THEN CAST('inf' AS DOUBLE) WHEN fsum(time_on_page) < 0 "
            "THEN CAST('-inf' AS DOUBLE) ELSE 0.0e0" if cfg.keep_inf else "ELSE 0.0e0")
    zone = q(cfg.home_zone)

    def sum_fam(col, prefix, suffix, fam):
        return (f"SELECT {q(fam)} AS fam, visitor_id, {q(prefix)} || {clean_sql(col)} || {q(suffix)} AS f, "
                f"CAST(sum(page_views) AS DOUBLE) AS v FROM fe_prep "
                f"WHERE visitor_id IS NOT NULL AND {col} IS NOT NULL GROUP BY visitor_id, f")

    def ratio_fam(col, prefix, suffix, fam):
        return (f"SELECT {q(fam)} AS fam, visitor_id, {q(prefix)} || {clean_sql(col)} || {q(suffix)} AS f, "
                f"CASE WHEN sum(page_views) <> 0 THEN fsum(time_on_page) / sum(page_views) {zero} END AS v "
                f"FROM fe_prep WHERE visitor_id IS NOT NULL AND {col} IS NOT NULL GROUP BY visitor_id, f")

    share = ("SELECT 't1_perc' AS fam, visitor_id, f, CASE WHEN tot = 0 THEN 0.0e0 ELSE s / tot END AS v FROM ("
             f"SELECT visitor_id, 't1_' || {clean_sql('tier1')} || '_perc_pvs' AS f, sum(page_views) AS s, "
             "sum(sum(page_views)) OVER (PARTITION BY visitor_id) AS tot FROM fe_prep "
             "WHERE visitor_id IS NOT NULL AND tier1 IS NOT NULL GROUP BY visitor_id, f)")
    long_parts = [sum_fam("referral_group", "rf_", "", "rf"), sum_fam("country", "ct_", "", "ct"),
                  sum_fam("device_os", "dos_", "", "dos"), sum_fam("tier1", "t1_", "", "t1"), share,
                  sum_fam("channel", "pc_", "", "pc"), sum_fam("section", "ps_", "_pvs", "ps"),
                  ratio_fam("tier1", "t1_", "_top", "t1_top"), ratio_fam("weekpart", "", "_top", "wk_top"),
                  ratio_fam("business_hours", "", "_top", "bh_top"),
                  ratio_fam("day_name", "", "_top", "dow_top"),
                  ratio_fam("day_of_month", "day_of_mon_", "_top", "dom_top"),
                  sum_fam("business_hours", "", "_pvs", "bh_pvs")]
    long_sql = "\n  UNION ALL ".join(long_parts)
    pattern = q(cfg.content_pattern)
    return f"""
fe_base AS (
  SELECT * REPLACE (coalesce(time_on_page, 0.0e0) AS time_on_page,
                    coalesce(sentiment_score, 0.0e0) AS sentiment_score,
                    CASE WHEN tier1 IS NULL OR trim(tier1, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN {q(cfg.other)}
                         ELSE tier1 END AS tier1)
  FROM pageviews WHERE content_id IS NOT NULL),
fe_tops AS (
  SELECT dim, cat FROM (
    SELECT dim, cat, row_number() OVER (PARTITION BY dim ORDER BY tot DESC, cat) AS rn FROM (
      {top_union}))
  WHERE rn <= {cfg.top_n}),
fe_prep0 AS (
  SELECT * REPLACE ({collapse}),
     TRY_CAST(CAST(view_date AS VARCHAR) AS DATE) AS d,
     make_timestamp(visit_start * 1000000) AS utc_ts
  FROM fe_base),
fe_prep1 AS (
  SELECT *, CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS weekpart,
     dayname(d) AS day_name, day(d) AS day_of_month,
     hour(CASE WHEN country = {home} THEN timezone({zone}, timezone('UTC', utc_ts)) ELSE utc_ts END) AS session_hour,
     minute(CASE WHEN country = {home} THEN timezone({zone}, timezone('UTC', utc_ts)) ELSE utc_ts END) AS session_minute
  FROM fe_prep0),
fe_prep AS (
  SELECT *, CASE WHEN session_hour >= 8 AND session_hour < 18 THEN 'business_hours'
                 ELSE 'non_business_hours' END AS business_hours
  FROM fe_prep1),
fe_page AS (
  SELECT visitor_id, visit_start, page_path, max(page_views) AS page_views,
         fsum(time_on_page) AS time_on_page
  FROM fe_prep WHERE visitor_id IS NOT NULL AND visit_start IS NOT NULL AND page_path IS NOT NULL
  GROUP BY ALL),
fe_map AS (
  SELECT page_path, content_id, publish_date FROM (
    SELECT page_path, content_id, publish_date, row_number() OVER (
      PARTITION BY page_path ORDER BY publish_date DESC NULLS LAST, content_id) AS rn
    FROM fe_prep WHERE page_path IS NOT NULL) WHERE rn = 1),
fe_sess AS (
  SELECT p.visitor_id, p.visit_start, CAST(sum(p.page_views) AS BIGINT) AS session_pvs,
         fsum(p.time_on_page) / count(*) AS session_top,
         CAST(sum(CASE WHEN regexp_matches(m.content_id, {pattern}) THEN p.page_views ELSE 0 END) AS BIGINT) AS content_pvs
  FROM fe_page p LEFT JOIN fe_map m USING (page_path) GROUP BY ALL),
fe_stats AS (
  SELECT visitor_id, avg(session_pvs) AS session_pvs_mean,
         median(CAST(session_pvs AS DOUBLE)) AS session_pvs_median,
         fsum(session_top) / count(session_top) AS session_top_mean,
         median(session_top) AS session_top_median,
         avg(CASE WHEN session_pvs = 1 THEN 1.0e0 ELSE 0.0e0 END) AS bounce_rate,
         CASE WHEN sum(session_pvs) = 0 THEN 0.0e0 ELSE sum(content_pvs) / sum(session_pvs) END AS content_views_rate
  FROM fe_sess GROUP BY visitor_id),
fe_row AS (
  SELECT visitor_id, fsum(sentiment_score) / count(sentiment_score) AS sentiment_score_mean,
         median(sentiment_score) AS sentiment_score_median
  FROM fe_prep WHERE visitor_id IS NOT NULL GROUP BY visitor_id
  HAVING count(referral_group) > 0 AND count(device_os) > 0 AND count(d) > 0),
fe_long AS (
  {long_sql})"""


def with_features(cfg: FeatureConfig) -> str:
    return duckdb_with_clause() + ",\n" + feature_ctes(cfg)


def dense_sql(ids: str, names: str, long: str) -> str:
    """(visitor_id, feature, value): every id with every feature name."""
    return (f"SELECT i.visitor_id, n.f AS feature, round(coalesce(l.v, 0.0e0), 6) AS value FROM ({ids}) i "
            f"CROSS JOIN ({names}) n LEFT JOIN ({long}) l ON l.visitor_id = i.visitor_id AND l.f = n.f")


_FIXED = {"fe_stats": ["session_pvs_mean", "session_pvs_median", "session_top_mean", "session_top_median",
                       "bounce_rate", "content_views_rate"],
          "fe_row": ["sentiment_score_mean", "sentiment_score_median"]}


def wide_sql(cfg: FeatureConfig, prefix: str = "fe_", names: str | None = None) -> str:
    """The full feature row in long form (query body after ``with_features``);
    ``names`` is a query of the category features ``f`` (default: all)."""
    ids = "SELECT visitor_id FROM fe_row WHERE visitor_id IN (SELECT visitor_id FROM fe_stats)"
    long = "SELECT visitor_id, f, v FROM fe_long WHERE fam <> 'bh_pvs'"
    parts = [dense_sql(ids, names or "SELECT DISTINCT f FROM fe_long WHERE fam <> 'bh_pvs'", long)]
    parts += [f"SELECT visitor_id, '{c}' AS feature, round({c}, 6) AS value FROM {t} WHERE visitor_id IN ({ids})"
              for t, cols in _FIXED.items() for c in cols]
    return "\nUNION ALL ".join(parts).replace("fe_", prefix)


def family_sql(fam: str) -> str:
    """One family alone (visitors with at least one categorised row)."""
    own = f"FROM fe_long WHERE fam = {q(fam)}"
    return dense_sql(f"SELECT DISTINCT visitor_id {own}", f"SELECT DISTINCT f {own}", f"SELECT visitor_id, f, v {own}")
