"""Visitor features.

The feature set is a list of *families*: a category column turned into one
feature per category value, holding a sum of page views, a share of the
visitor's views, or a ratio of time to views. All families come from one
aggregate by (visitor, category columns), which combines a visitor's equal
rows before any shuffle and spreads a visitor with many rows over its
categories, and one more by (visitor, family, feature): the long form. The
long form needs no list of categories, so no domain is bounded or collected;
only a wide row does, as its columns are the categories.

Session statistics come from the page grain ``(visitor, session, path)`` ->
session grain ``(visitor, session)`` -> visitor. Medians come from counts
``(visitor, value, count)`` in value order. The visitor-grain results are joined once,
on a key that is unique on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.calendar import (
    business_hours, day_name, parse_date, session_start, weekpart)
from kindred.functions.text import clean_name, clean_name_str, matches
from kindred.operators.clean import clean_views, collapse, top_categories
from kindred.sources.session import materialize

V, VS, PATH, PV, TIME = "visitor_id", "visit_start", "page_path", "page_views", "time_on_page"
CONTENT, SENT, DATE, PUB = "content_id", "sentiment_score", "view_date", "publish_date"


def exact_sum(col) -> Column:
    """Sum of a double column in fixed point (scale 12), as double: it does
    not depend on the order rows meet in (partitioning, retries)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(38,12)")).cast("double")


def exact_avg(col) -> Column:
    """Mean of a double column, accumulated in fixed point (scale 12)."""
    c = F.col(col) if isinstance(col, str) else col
    return exact_sum(c) / F.count(c)


@dataclass(frozen=True)
class FeatureConfig:
    top_n: int = 15
    collapse_columns: tuple = ("country", "channel", "section")
    home_country: str = "united states"
    home_zone: str = "America/New_York"
    # Fixed value: content ids counted as content views (case-sensitive).
    content_pattern: str = "blogandpostid|blogandslideid|galleryid|video"
    # x/0 gives 0 for the model; with this it is +-inf as in the source system.
    keep_inf: bool = False
    other: str = "other"
    # Opt-in: approximate medians (fixed-size sketch per visitor) instead of
    # exact ones (a visitor's distinct values sorted in one task).
    approx_median: bool = False


@dataclass(frozen=True)
class Family:
    column: str
    prefix: str
    suffix: str
    kind: str  # "sum" | "share" | "ratio"


# Families of the wide feature row, in output order (session statistics,
# sentiment, bounce and content rate are placed around them by ``build_wide``).
REFERRAL = Family("referral_group", "rf_", "", "sum")
COUNTRY = Family("country", "ct_", "", "sum")
DEVICE_OS = Family("device_os", "dos_", "", "sum")
TIER1 = Family("tier1", "t1_", "", "sum")
TIER1_SHARE = Family("tier1", "t1_", "_perc_pvs", "share")
CHANNEL = Family("channel", "pc_", "", "sum")
SECTION = Family("section", "ps_", "_pvs", "sum")
TIER1_TOP = Family("tier1", "t1_", "_top", "ratio")
WEEKPART_TOP = Family("weekpart", "", "_top", "ratio")
BUSINESS_TOP = Family("business_hours", "", "_top", "ratio")
DAY_NAME_TOP = Family("day_name", "", "_top", "ratio")
DAY_OF_MONTH_TOP = Family("day_of_month", "day_of_mon_", "_top", "ratio")
BUSINESS_PVS = Family("business_hours", "", "_pvs", "sum")

HEAD_FAMILIES = (REFERRAL, COUNTRY, DEVICE_OS, TIER1, TIER1_SHARE, CHANNEL, SECTION, TIER1_TOP)
TAIL_FAMILIES = (WEEKPART_TOP, BUSINESS_TOP, DAY_NAME_TOP, DAY_OF_MONTH_TOP)

FAMILIES = HEAD_FAMILIES + TAIL_FAMILIES

# Columns whose categories are numbers: their features stand in numeric order.
INT_COLUMNS = {"day_of_month"}


@dataclass
class Vocabulary:
    """The top-n lists: at most ``top_n`` values of each collapsed column."""
    tops: dict = field(default_factory=dict)      # column -> [values]

    @staticmethod
    def build(cleaned: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> "Vocabulary":
        voc = Vocabulary({c: [] for c in cfg.collapse_columns})
        for r in top_categories(cleaned, list(cfg.collapse_columns), cfg.top_n).collect():
            voc.tops[r["dimension"]].append(r["category"])
        return voc


def prepare(cleaned: DataFrame, voc: Vocabulary, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Collapse to the top-n lists and add the calendar and clock columns."""
    out = cleaned
    for c in cfg.collapse_columns:
        out = out.withColumn(c, collapse(c, voc.tops.get(c, []), cfg.other))
    d = parse_date(F.col(DATE))
    local = session_start(F.col(VS), F.col("country"), cfg.home_country, cfg.home_zone)
    return (out.withColumns({"_date": d, "weekpart": weekpart(d), "day_name": day_name(d),
                             "day_of_month": F.dayofmonth(d), "session_hour": F.hour(local),
                             "session_minute": F.minute(local)})
            .withColumn("business_hours", business_hours(F.col("session_hour"))))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _by_category(rows: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """``keep, column, raw``: a row for each non-null category of ``rows``;
    ``column`` is the position in ``columns``."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("raw"))
                               for i, c in enumerate(columns)])).alias("_e")
    return rows.select(*keep, each).where("_e.raw IS NOT NULL").select(*keep, "_e.column", "_e.raw")


def long_features(prepared: DataFrame, families=FAMILIES, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """``visitor_id, family, feature, value``: one row for each feature a
    visitor has (absent ones are 0); ``family`` is the position in
    ``families``. Categories whose cleaned names are equal are one feature.

    Sums go by (visitor, category columns), then by (visitor, column,
    category); only what is left is given its features' names.
    """
    return features_of_sums(category_sums(prepared, families), families, cfg)


def category_sums(prepared: DataFrame, families=FAMILIES) -> DataFrame:
    """``visitor_id, column, raw, _pv, _t``: views and time by visitor and
    category; ``column`` is the position among the sorted category columns."""
    cats = sorted({f.column for f in families})
    measures = [F.sum("_pv").alias("_pv"), F.sum("_t").alias("_t")]
    rows = (prepared.where(F.col(V).isNotNull()).groupBy(V, *cats)
            .agg(F.sum(PV).alias("_pv"), F.sum(F.col(TIME).cast("decimal(38,12)")).alias("_t")))
    # A visitor's combinations meet here once; what is summed, named, ranked
    # and pivoted by visitor after that needs no other exchange.
    return _by_category(rows.repartition(V), cats, V, "_pv", "_t").groupBy(V, "column", "raw").agg(*measures)


def features_of_sums(by_cat: DataFrame, families=FAMILIES, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The long form from ``category_sums``."""
    cats = sorted({f.column for f in families})

    def named(column: str) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("family"),
                                  F.concat(F.lit(f.prefix), clean_name("raw"), F.lit(f.suffix)).alias("feature"))
                         for k, f in enumerate(families) if f.column == column])

    entries = F.coalesce(*[F.when(F.col("column") == i, named(c)) for i, c in enumerate(cats)])
    sums = (by_cat.select(V, "_pv", "_t", F.explode(entries).alias("_e")).select(V, "_pv", "_t", "_e.*")
            .groupBy(V, "family", "feature").agg(F.sum("_pv").alias("_pv"), F.sum("_t").cast("double").alias("_t")))
    of = {k: [i for i, f in enumerate(families) if f.kind == k] for k in ("share", "ratio")}
    value = F.col("_pv").cast("double")
    if of["ratio"]:
        value = F.when(F.col("family").isin(of["ratio"]), ratio(F.col("_t"), F.col("_pv"), cfg.keep_inf)).otherwise(value)
    if of["share"]:
        total = F.sum("_pv").over(Window.partitionBy(V, "family"))
        value = F.when(F.col("family").isin(of["share"]), ratio(F.col("_pv"), total)).otherwise(value)
    return sums.select(V, "family", "feature", value.alias("value"))


def feature_names(prepared: DataFrame, families=FAMILIES) -> list[tuple[int, str]]:
    """``(family, feature)`` in the order of a wide row: by family, then by
    category (numbers in numeric order). One entry a category: as many as
    the wide row they are asked for has columns."""
    cats = sorted({f.column for f in families})
    return names_of(_by_category(prepared.where(F.col(V).isNotNull()), cats).distinct(), families)


def names_of(categories: DataFrame, families=FAMILIES) -> list[tuple[int, str]]:
    """``feature_names`` from the distinct ``column, raw``."""
    cats = sorted({f.column for f in families})
    found = categories.collect()
    out: list[tuple[int, str]] = []
    for k, f in enumerate(families):
        raws = [r["raw"] for r in found if cats[r["column"]] == f.column]
        raws.sort(key=int if f.column in INT_COLUMNS else None)
        out += dict.fromkeys((k, f.prefix + clean_name_str(r) + f.suffix) for r in raws)
    return out


def pivot_long(long: DataFrame, names: list[tuple[int, str]]) -> DataFrame:
    """One row per visitor with a column ``family:feature`` for each name;
    absent features are 0, others are left out."""
    keys = [f"{k}:{n}" for k, n in names]
    keyed = long.withColumn("_k", F.concat_ws(":", F.col("family").cast("string"), "feature"))
    wide = keyed.groupBy(V).pivot("_k", keys).agg(F.sum("value"))
    return wide.select(V, *[F.coalesce(F.col(quoted(k)), F.lit(0.0)).alias(k) for k in keys])


def ratio(num: Column, den: Column, keep_inf: bool = False) -> Column:
    """num / den with the feature zero policy: 0/0, absent and (by default)
    x/0 give 0. With ``keep_inf`` x/0 gives ±inf as in the source system."""
    base = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    if not keep_inf:
        return base
    return (F.when((den == 0) & (num > 0), F.lit(float("inf")))
            .when((den == 0) & (num < 0), F.lit(float("-inf")))
            .otherwise(base))


def pivot_family(prepared: DataFrame, fam: Family, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """One family as a wide frame: visitors with at least one categorised row."""
    names = feature_names(prepared, (fam,))
    return pivot_long(long_features(prepared, (fam,), cfg), names).toDF(V, *[n for _, n in names])


# ---- page and session grain ------------------------------------------------

def page_grain(cleaned: DataFrame) -> DataFrame:
    """Per (visitor, session, path): max page views and summed time."""
    keys = [V, VS, PATH]
    return (cleaned.where(F.col(V).isNotNull() & F.col(VS).isNotNull() & F.col(PATH).isNotNull())
            .groupBy(*keys).agg(F.max(PV).alias(PV), exact_sum(TIME).alias(TIME)))


def page_content_map(cleaned: DataFrame) -> DataFrame:
    """Newest content per path (publish date desc, nulls last, then content
    id). Distinct triples are found by hash aggregation first, so what is
    ranked is small however many rows a path has."""
    triples = cleaned.where(F.col(PATH).isNotNull()).select(PATH, CONTENT, PUB).distinct()
    order = Window.partitionBy(PATH).orderBy(F.desc_nulls_last(PUB), F.asc(CONTENT))
    return triples.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def session_grain(pages: DataFrame, content_map: DataFrame | None = None,
                  cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Per (visitor, session): summed page maxima and mean page time; with a
    content map also the views of pages whose content id matches the pattern."""
    aggs = [F.sum(PV).alias("session_pvs"),
            (exact_sum(TIME) / F.count(F.lit(1))).alias("session_top")]
    src = pages
    if content_map is not None:
        src = pages.join(content_map.select(PATH, CONTENT), PATH, "left")
        is_content = matches(F.col(CONTENT), cfg.content_pattern)
        aggs.append(F.sum(F.when(is_content, F.col(PV)).otherwise(F.lit(0))).alias("content_pvs"))
    return src.groupBy(V, VS).agg(*aggs)


def _cumulated(counts: DataFrame, *keys: str) -> DataFrame:
    """``_upto`` and ``_all`` of value counts ``_v, _c`` by ``keys``: running
    and whole sums in value order. Rows are sorted and may spill; a key with
    very many values never has to fit into memory."""
    by = Window.partitionBy(*keys)
    upto = by.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("_c").over(upto)).withColumn("_all", F.sum("_c").over(by))


def _median(of: Column) -> Column:
    """Exact median from cumulated counts: the mean of the two middle values."""
    low = F.min(F.when(of & (2 * F.col("_upto") >= F.col("_all")), F.col("_v")))
    high = F.min(F.when(of & (2 * F.col("_upto") > F.col("_all")), F.col("_v")))
    return (low + high) / 2


def session_stats(sessions: DataFrame, approx: bool = False) -> DataFrame:
    """Visitor statistics over sessions: mean/median views and time, bounce
    rate and (if present) content view rate, all from one aggregate of value
    counts. ``approx`` uses quantile sketches for the medians instead."""
    content = "content_pvs" in sessions.columns
    if approx:
        med = lambda c: F.percentile_approx(c, 0.5).cast("double")
        aggs = [F.avg("session_pvs").alias("session_pvs_mean"), med("session_pvs").alias("session_pvs_median"),
                exact_avg("session_top").alias("session_top_mean"), med("session_top").alias("session_top_median"),
                F.avg((F.col("session_pvs") == 1).cast("double")).alias("bounce_rate"),
                F.sum("session_pvs").alias("_pvs")] + [F.sum("content_pvs").alias("_content")] * content
        out = sessions.groupBy(V).agg(*aggs)
    else:
        names = ["session_pvs", "session_top"] + ["content_pvs"] * content
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).cast("double").alias("v")) for n in names]))
        counts = (sessions.select(V, cells.alias("_e")).groupBy(V, F.col("_e.k").alias("_k"), F.col("_e.v").alias("_v"))
                  .agg(F.count("_e.v").alias("_c"), F.count(F.lit(1)).alias("_rows")))
        is_ = {n: F.col("_k") == n for n in names}
        exact = F.col("_v").cast("decimal(24,12)") * F.col("_c").cast("decimal(12,0)")
        total = {n: F.sum(F.when(is_[n], exact)).cast("double") for n in names}
        n_of = {n: F.sum(F.when(is_[n], F.col("_c"))) for n in names}
        aggs = []
        for n in names[:2]:
            aggs += [(total[n] / n_of[n]).alias(n + "_mean"), _median(is_[n]).alias(n + "_median")]
        single = F.sum(F.when(is_["session_pvs"] & (F.col("_v") == 1), F.col("_c")).otherwise(0))
        aggs += [(single / F.sum(F.when(is_["session_pvs"], F.col("_rows")))).alias("bounce_rate"),
                 total["session_pvs"].alias("_pvs")] + [total[n].alias("_content") for n in names[2:]]
        out = _cumulated(counts, V, "_k").groupBy(V).agg(*aggs)
    if content:
        out = out.withColumn("content_views_rate", F.coalesce(F.try_divide("_content", "_pvs"), F.lit(0.0))).drop("_content")
    return out.drop("_pvs")


# ---- the wide feature row ----------------------------------------------------

SESSION_COLUMNS = ["session_pvs_mean", "session_pvs_median", "session_top_mean", "session_top_median"]
SENTIMENT_COLUMNS = ["sentiment_score_mean", "sentiment_score_median"]


def eligible_visitors(cleaned: DataFrame) -> DataFrame:
    """Visitors that have a feature row: some row with a referral group, one
    with a device, one with a date, and one with a session and a path."""
    return (cleaned.where(F.col(V).isNotNull()).groupBy(V)
            .agg(F.count("referral_group").alias("_rf"), F.count("device_os").alias("_dos"),
                 F.count(parse_date(F.col(DATE))).alias("_date"),
                 F.count(F.when(F.col(VS).isNotNull() & F.col(PATH).isNotNull(), 1)).alias("_sess"))
            .where("_rf > 0 AND _dos > 0 AND _date > 0 AND _sess > 0").select(V))


def sentiment_median(rows: DataFrame, approx: bool = False) -> DataFrame:
    """Exact median per visitor from (visitor, value, count); ``approx`` uses
    a fixed-size quantile sketch instead."""
    own = rows.where(F.col(V).isNotNull())
    if approx:
        return own.groupBy(V).agg(F.percentile_approx(SENT, 0.5).cast("double").alias("sentiment_score_median"))
    return median_of_counts(own.groupBy(V, F.col(SENT).cast("double").alias("_v")).agg(F.count(SENT).alias("_c")))


def median_of_counts(counts: DataFrame) -> DataFrame:
    """Exact sentiment median per visitor from value counts ``_v, _c``."""
    return _cumulated(counts, V).groupBy(V).agg(_median(F.lit(True)).alias("sentiment_score_median"))


def build_wide(views: DataFrame, cfg: FeatureConfig = FeatureConfig(), voc: Vocabulary | None = None,
               names: list[tuple[int, str]] | None = None) -> DataFrame:
    """Raw joined page-view rows -> one wide feature row per visitor.

    ``names`` (of ``feature_names``) fixes the category columns, e.g. to
    those of a training set; by default they are the ones found.
    """
    cleaned = clean_views(views)
    prepared = prepare(cleaned, voc or Vocabulary.build(cleaned, cfg), cfg)
    long = long_features(prepared, FAMILIES, cfg)
    names = feature_names(prepared) if names is None else names
    means = (prepared.where(F.col(V).isNotNull()).groupBy(V).agg(exact_avg(SENT).alias("sentiment_score_mean")))
    # stored, so that the join with the pages has plain exchanges on both
    # sides and a path with very many pages can be split at run time
    content = materialize(page_content_map(prepared), "paths")
    sess = session_stats(session_grain(page_grain(prepared), content, cfg), cfg.approx_median)
    return wide_row(long, names, eligible_visitors(cleaned), means, sess, sentiment_median(prepared, cfg.approx_median))


def wide_row(long: DataFrame, names: list[tuple[int, str]], eligible: DataFrame, means: DataFrame, sess: DataFrame,
             medians: DataFrame) -> DataFrame:
    """The wide row from its parts, each by visitor."""
    joined = pivot_long(long, names).join(eligible, V, "left_semi").join(means, V).join(sess, V).join(medians, V)
    cats = [(k, F.col(quoted(f"{k}:{n}")).alias(n)) for k, n in names]
    n_head = len(HEAD_FAMILIES)
    return joined.select(
        V, *[F.col(c).cast("double").alias(c) for c in SESSION_COLUMNS + SENTIMENT_COLUMNS],
        *[c for k, c in cats if k < n_head], "bounce_rate", "content_views_rate",
        *[c for k, c in cats if k >= n_head])


def feature_columns(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c != V]
