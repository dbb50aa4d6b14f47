"""Dimension enrichment: latest-version selection, content / category /
sentiment joins, label semi and anti joins, subscriber ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.calendar import to_local
from kindred.functions.text import matches
from kindred.sources.session import materialize

# Content types that count as articles.
ARTICLE_TYPES = ["blog", "blogslide", "magazine"]
# Fixed value: path of the newsletter unsubscribe confirmation (case-insensitive).
UNSUBSCRIBE_PATH = "newsletter/unsubscribe-confirmation"


def latest_per_key(df: DataFrame, key: str | Column, order: str | Column) -> DataFrame:
    """Rows whose ``order`` is the newest for their ``key``; ties are all kept
    (``rank() = 1``). Spark plans this with a partial ``WindowGroupLimit``
    before the shuffle, so a hot key is cut down map-side."""
    k = F.col(key) if isinstance(key, str) else key
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(k).orderBy(o.desc())
    return df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_sentiment(sentiment: DataFrame) -> DataFrame:
    """Newest sentiment row per article (ties kept); id lower-cased."""
    return (latest_per_key(sentiment, "natid", "pub_date")
            .select(F.lower("natid").alias("sentiment_key"), F.col("pub_date").alias("scored_on"),
                    "clean_body", "sentiment_score"))


def filter_articles(content: DataFrame, types: list[str] = ARTICLE_TYPES) -> DataFrame:
    return content.where(F.col("visible") & F.col("type").isin(types))


def latest_content(content: DataFrame, zone: str = "America/New_York",
                   types: list[str] = ARTICLE_TYPES) -> DataFrame:
    """Newest visible article version per raw-case id, then distinct on the
    lower-cased id, local publish time, title and body; publish date is the
    date of the local time."""
    ranked = latest_per_key(filter_articles(content, types), "natural_id", "version_ts")
    # DISTINCT over (local time, title, body, id), keyed by a digest of the
    # body: rows of one group have the same body, which is carried by
    # ``first`` and pruned, with no text shuffled, when no later step reads it.
    keyed = ranked.select(to_local(F.col("published_at"), zone).alias("_local"), "title", "body",
                          F.lower("natural_id").alias("article_key"), F.md5("body").alias("_digest"))
    return (keyed.groupBy("_local", "title", "article_key", "_digest").agg(F.first("body").alias("body"))
            .select("article_key", F.to_date("_local").alias("publish_date"), "title", "body"))


def latest_category(category: DataFrame) -> DataFrame:
    """Newest category per content id; distinct (several may tie)."""
    return (latest_per_key(category, "natid", "ts")
            .select(F.col("category").alias("tier1"), F.col("natid").alias("category_key")).distinct())


def content_with_category(content: DataFrame, category: DataFrame,
                          zone: str = "America/New_York") -> DataFrame:
    """Latest articles joined with their latest category on the lower-cased id."""
    c, k = latest_content(content, zone), latest_category(category)
    return c.join(k, F.lower("article_key") == F.lower("category_key")).drop("category_key")


def article_facts(content: DataFrame, category: DataFrame, sentiment: DataFrame,
                  zone: str = "America/New_York", text: bool = False) -> DataFrame:
    """What page views need of articles, by ``fact_key``: each latest article
    and category with each latest sentiment of the same id, or either alone.
    Joining this once gives the rows of the two left joins in a row. The
    texts (``body``, ``clean_body``) come along only with ``text``."""
    c, s = content_with_category(content, category, zone), latest_sentiment(sentiment)
    if not text:
        c, s = c.drop("body"), s.drop("clean_body")
    both = c.join(s, c["article_key"] == s["sentiment_key"], "full_outer")
    return both.withColumn("fact_key", F.coalesce("article_key", "sentiment_key")).where("fact_key IS NOT NULL")


def left_join_on_id(views: DataFrame, dim: DataFrame, dim_key: str, key: str = "content_id") -> DataFrame:
    """Rows left-joined with ``dim`` on the lower-cased id; columns of ``dim``
    replace those of the rows. Rows without an id match nothing and are kept
    out of the join, where they would all meet in one task. With ``dim`` a
    stored table, an id with very many rows is split at run time."""
    v = views.drop(*[c for c in dim.columns if c in views.columns])
    met = v.where(F.col(key).isNotNull()).join(dim, F.lower(F.col(key)) == F.col(dim_key), "left")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema]
    return met.unionByName(v.where(F.col(key).isNull()).select("*", *none))


def join_content(views: DataFrame, content_t: DataFrame, key: str = "content_id") -> DataFrame:
    """Page views left-joined with article data on the lower-cased id."""
    return left_join_on_id(views, content_t, "article_key", key)


def join_sentiment(views: DataFrame, sentiment_t: DataFrame, key: str = "content_id") -> DataFrame:
    """Rows left-joined with the latest sentiment on the lower-cased id."""
    return left_join_on_id(views, sentiment_t, "sentiment_key", key)


def keep_visitors(views: DataFrame, ids: DataFrame, key: str = "visitor_id",
                  id_col: str = "visitor_id") -> DataFrame:
    """Semi join: rows of visitors present in ``ids``."""
    return views.join(ids.select(F.col(id_col).alias(key)), key, "left_semi")


def drop_visitors_not_in(views: DataFrame, ids: DataFrame, key: str = "visitor_id",
                         id_col: str = "visitor_id") -> DataFrame:
    """SQL ``key NOT IN (SELECT id_col FROM ids)`` with its null semantics,
    planned without a nested-loop join.

    One small aggregate over ``ids`` decides the plan: an empty list keeps
    every row; a null in the list keeps none; otherwise rows with a non-null
    key absent from the list (``left_anti``, broadcast or shuffled by AQE).
    """
    stats = ids.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col(id_col).isNull()).alias("nulls")).first()
    if stats["n"] == 0:
        return views
    if stats["nulls"] > 0:
        return views.limit(0)
    anti = ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias(key))
    return views.where(F.col(key).isNotNull()).join(anti, key, "left_anti")


def active_subscriber_ids(subscriptions: DataFrame, views: DataFrame,
                          resources: list[str], status: str = "active",
                          max_refund: float = 1.0) -> DataFrame:
    """Distinct visitor ids of active, unrefunded subscribers of ``resources``,
    matched through the lower-cased piano id."""
    subs = (subscriptions.where(F.col("resource_id").isin(list(resources))
                                & (F.col("status") == status)
                                & (F.col("total_refunded") < max_refund))
            .select(F.lower("user_id_uid").alias("_uid")).distinct())
    v = views.select("visitor_id", F.lower("piano_id").alias("_uid"))
    return v.join(subs, "_uid", "inner").select("visitor_id").distinct()


def unsubscriber_ids(views: DataFrame, path: str = UNSUBSCRIBE_PATH) -> DataFrame:
    """Distinct visitors who reached the newsletter unsubscribe page."""
    return (views.where(matches("page_path", path, case_sensitive=False))
            .select("visitor_id").distinct())


def membership_flag(df: DataFrame, ids: DataFrame, name: str, yes: str, no: str,
                    key: str = "visitor_id") -> DataFrame:
    """Add ``name`` = ``yes`` for keys found in ``ids`` (distinct), else ``no``."""
    marks = ids.select(F.col(key), F.lit(True).alias("_hit")).distinct()
    return (df.join(marks, key, "left")
            .withColumn(name, F.when(F.col("_hit"), F.lit(yes)).otherwise(F.lit(no)))
            .drop("_hit"))


def add_flags(features: DataFrame, nl_views: DataFrame, subscriptions: DataFrame,
              sub_views: DataFrame, resources: list[str]) -> DataFrame:
    """Newsletter flag (from the rows the features came from) and subscriber
    flag (from all page views of active subscribers), as string columns."""
    out = membership_flag(features, unsubscriber_ids(nl_views), "nl_subscription",
                          "nl_unsubscriber", "nl_subscriber")
    return membership_flag(out, active_subscriber_ids(subscriptions, sub_views, resources),
                           "subscriber", "subscriber", "non_subscriber")


def raw_rows(views: DataFrame, content: DataFrame, category: DataFrame,
             sentiment: DataFrame, start: str | None = None, end: str | None = None,
             labelled: DataFrame | None = None, exclude: DataFrame | None = None,
             sampled: DataFrame | None = None, zone: str = "America/New_York", text: bool = False) -> DataFrame:
    """The joined page-view rows the features are built from: date window,
    semi join to labelled (training) or sampled visitors, null-aware
    exclusion of labelled ones (scoring), latest article + category, latest
    sentiment. Rows are cut down before the one join with the stored article
    facts, which carry no text unless asked for."""
    v = views
    if start is not None:
        v = v.where(F.col("view_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    for ids in (labelled, sampled):
        if ids is not None:
            v = keep_visitors(v, ids)
    if exclude is not None:
        v = drop_visitors_not_in(v, exclude)
    facts = materialize(article_facts(content, category, sentiment, zone, text), "articles")
    return left_join_on_id(v, facts, "fact_key").drop("fact_key")
