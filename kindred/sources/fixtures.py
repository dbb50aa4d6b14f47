"""Fixture adapter: the engine's logical source tables, derived from the
driver's test tables (``events customer nation region documents labels``).

The view bodies are written once and rendered in two dialects: Spark SQL
(run here, with the driver tables passed as DataFrame arguments) and
DuckDB (used by the oracle queries). They are test adapters, not engine
features; in production the logical tables are real catalog tables.

Placeholders: ``{STR}`` string type, ``{TS}`` wall-clock timestamp type,
``{JSON_K}`` the ``k`` field of ``events.props``, ``{EPOCH}`` epoch seconds of
``e.ts``, ``{VERS2}``/``{VERS3}`` a generator of version numbers. Table
references are ``{events}`` etc.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from kindred.sources.session import materialize

DIALECTS = {
    "spark": {
        "STR": "STRING",
        "TS": "TIMESTAMP_NTZ",
        "JSON_K": "get_json_object(props, '$.k')",
        "EPOCH": "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', e.ts)",
        "VERS2": "explode(array(0, 1))",
        "VERS3": "explode(array(0, 1, 2))",
    },
    "duckdb": {
        "STR": "VARCHAR",
        "TS": "TIMESTAMP",
        "JSON_K": "json_extract_string(props, '$.k')",
        "EPOCH": "CAST(floor(epoch(e.ts)) AS BIGINT)",
        "VERS2": "unnest([0, 1])",
        "VERS3": "unnest([0, 1, 2])",
    },
}

DRIVER_TABLES = ("events", "customer", "nation", "region", "documents", "labels")

# Logical tables in dependency order: name -> (body, referenced tables).
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "pageviews": ("""
SELECT e.event_id, e.user_id AS visitor_id,
  CONCAT('Uid_', CAST(e.user_id AS {STR})) AS piano_id,
  vs.visit_start,
  CAST(e.ts AS DATE) AS view_date,
  CASE WHEN e.k = 13 THEN '/Newsletter/Unsubscribe-Confirmation'
       ELSE CONCAT('/', e.event_type, '/', CAST(e.k AS {STR})) END AS page_path,
  CASE WHEN e.k % 17 = 0 THEN 0 ELSE 1 + e.k % 3 END AS page_views,
  CASE WHEN e.k % 10 = 0 THEN NULL ELSE e.value * 0.7310585786300049e0 END AS time_on_page,
  CASE WHEN e.event_type = 'error' THEN NULL
       WHEN e.k % 2 = 0 THEN CONCAT('blogandpostid_', CAST(e.k AS {STR}))
       ELSE CONCAT('channel_', CAST(e.k AS {STR})) END AS content_id,
  d.source AS channel, d.lang AS section,
  CASE WHEN e.k % 7 = 0 THEN ' ' WHEN e.k % 11 = 0 THEN NULL
       WHEN e.k % 13 = 0 THEN 'news.example.com' ELSE CONCAT('Cat & ', d.source) END AS tier1,
  n.n_name AS country, r.r_name AS referral_group, cu.c_mktsegment AS device_os,
  CASE e.k % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
  CASE e.k % 4 WHEN 0 THEN 'chrome' WHEN 1 THEN 'safari' WHEN 2 THEN 'edge' ELSE NULL END AS device_browser,
  CAST(l.quality - l.toxic AS DOUBLE) AS sentiment_score,
  make_date(2024, 1, CAST(1 + e.k % 28 AS INT)) AS publish_date
FROM (SELECT event_id, user_id, ts, event_type, value, CAST({JSON_K} AS INT) AS k
      FROM {events}) e
LEFT JOIN (SELECT e.user_id, CAST(e.ts AS DATE) AS vdate, MIN({EPOCH}) AS visit_start
           FROM {events} e GROUP BY e.user_id, CAST(e.ts AS DATE)) vs
  ON vs.user_id = e.user_id AND vs.vdate = CAST(e.ts AS DATE)
LEFT JOIN {documents} d ON d.doc_id = e.k
LEFT JOIN {labels} l ON l.doc_id = e.k
LEFT JOIN {customer} cu ON cu.c_custkey = e.user_id
LEFT JOIN {nation} n ON n.n_nationkey = cu.c_nationkey
LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey
""", ("events", "documents", "labels", "customer", "nation", "region")),

    "content": ("""
SELECT CASE WHEN d.doc_id % 2 = 0 THEN CONCAT('BlogAndPostId_', CAST(d.doc_id AS {STR}))
            ELSE CONCAT('Channel_', CAST(d.doc_id AS {STR})) END AS natural_id,
  CAST(make_date(2024, 1, CAST(1 + d.doc_id % 28 AS INT)) AS {TS}) + INTERVAL '3' HOUR AS published_at,
  CAST(make_date(2024, 2, CAST(1 + CASE WHEN d.doc_id % 5 = 0 THEN 0 ELSE d.ver END AS INT)) AS {TS}) AS version_ts,
  CONCAT('t', CAST(d.doc_id AS {STR}), '_', CAST(d.ver AS {STR})) AS title, d.text AS body,
  d.doc_id % 9 <> 0 AS visible,
  CASE d.doc_id % 4 WHEN 0 THEN 'blog' WHEN 1 THEN 'blogslide' WHEN 2 THEN 'magazine' ELSE 'landing' END AS type
FROM (SELECT doc_id, text, {VERS3} AS ver FROM {documents}) d
""", ("documents",)),

    "content_category": ("""
SELECT LOWER(natural_id) AS natid,
  CASE WHEN version_ts = CAST('2024-02-01 00:00:00' AS {TS}) THEN CONCAT('Cat ', title)
       ELSE CONCAT('Cat & ', type) END AS category,
  version_ts AS ts
FROM {content}
""", ("content",)),

    "sentiment": ("""
SELECT CASE WHEN l.doc_id % 2 = 0 THEN CONCAT('BlogAndPostId_', CAST(l.doc_id AS {STR}))
            ELSE CONCAT('Channel_', CAST(l.doc_id AS {STR})) END AS natid,
  make_date(2024, 1, CAST(1 + l.ver AS INT)) AS pub_date,
  CONCAT('body ', CAST(l.doc_id AS {STR})) AS clean_body,
  l.quality - l.toxic * 0.5e0 + l.ver AS sentiment_score
FROM (SELECT doc_id, quality, toxic, {VERS2} AS ver FROM {labels}) l
""", ("labels",)),

    "subscriptions": ("""
SELECT UPPER(CONCAT('uid_', CAST(c_custkey AS {STR}))) AS user_id_uid,
  CASE c_custkey % 3 WHEN 0 THEN 'PLAN_A' WHEN 1 THEN 'PLAN_B' ELSE 'PLAN_C' END AS resource_id,
  CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'cancelled' END AS status,
  c_custkey % 4 * 0.5e0 AS total_refunded
FROM {customer}
""", ("customer",)),

    "seed_labels": ("""
SELECT c_custkey AS visitor_id, c_name AS user_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'C-Level'
       WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'Manager' END AS management_level
FROM {customer} WHERE c_custkey % 3 <> 0
""", ("customer",)),

    "predictions": ("""
SELECT c_custkey AS visitor_id, c_custkey * 37 % 100 / 100e0 AS probability,
  CASE WHEN c_custkey * 37 % 100 > 50 THEN 1 ELSE 0 END AS predicted
FROM {customer} WHERE c_custkey % 3 = 0
""", ("customer",)),
}


def render(body: str, dialect: str) -> str:
    """Fill the dialect placeholders; table references stay as ``{name}``."""
    out = body
    for key, val in DIALECTS[dialect].items():
        out = out.replace("{" + key + "}", val)
    return out


def duckdb_with_clause(names: list[str] | None = None) -> str:
    """``WITH`` clause defining the logical tables for DuckDB."""
    names = list(VIEWS) if names is None else names
    parts = []
    for name in VIEWS:
        if name not in names:
            continue
        body, deps = VIEWS[name]
        text = render(body, "duckdb")
        for dep in deps:
            text = text.replace("{" + dep + "}", dep)
        parts.append(f"{name} AS ({text.strip()})")
    return "WITH " + ",\n".join(parts)


class Fixtures:
    """Lazily built Spark DataFrames for the logical tables of one scale.

    With ``store=True`` each derived view is written once as a parquet table:
    the views stand in for stored source tables, so queries read them by
    pruned scans with pushed filters and do not derive them in every branch.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, store: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = store
        self._cache: dict[str, DataFrame] = {}

    def driver_table(self, name: str) -> DataFrame:
        key = "raw:" + name
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(
                os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS:
            raise AttributeError(name)
        return self.view(name)

    def view(self, name: str) -> DataFrame:
        if name not in self._cache:
            body, deps = VIEWS[name]
            args = {d: (self.view(d) if d in VIEWS else self.driver_table(d))
                    for d in deps}
            df = self.spark.sql(render(body, "spark"), **args)
            if self.store:
                df = materialize(df, name)
            self._cache[name] = df
        return self._cache[name]
