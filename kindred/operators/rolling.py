"""Visitor features of a moving window from mergeable partial states.

Four tables hold what a day's page views add to the features, as sums and
counts by key, so days merge by addition and leave by subtraction:

* ``cats``: views, time and rows by (visitor, category column, category)
* ``pages``: time and rows by (visitor, session, path, page views): the page
  grain needs the largest page views, which a count by value can give up again
* ``sentiment``: rows by (visitor, score): mean and median
* ``paths``: rows by (path, content, publish date): newest content per path

``write_days`` stores them by day. A window's state is their sum over its
days; ``move_window`` derives the next state from the stored one, the days
that enter and the days that leave, and reads no other day. Keys whose row
count falls to zero are dropped. Sums are integers or fixed point, so a moved
state equals one built anew. Features need the window's own top-n lists, so
categories are kept raw and collapsed only when features are asked for.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions.calendar import business_hours, day_name, epoch_to_utc, parse_date, to_local, weekpart
from kindred.operators import features as fe
from kindred.operators.clean import clean_views, collapse
from kindred.operators.features import CONTENT, DATE, PATH, PUB, PV, SENT, TIME, V, VS
from kindred.sources.session import materialize

KEYS = {"cats": [V, "column", "raw"], "pages": [V, VS, PATH, PV], "sentiment": [V, "score"], "paths": [PATH, CONTENT, PUB]}
SUMS = {"cats": ["n", "views", "time"], "pages": ["n", "time"], "sentiment": ["n"], "paths": ["n"]}
# Whether a visitor's country is the home country is known per row, whether it
# stays one of the window's top categories only per window: both clocks are kept.
AT_HOME, AWAY = "business_hours@home", "business_hours@away"
COLUMNS = sorted({f.column for f in fe.FAMILIES})


def _day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


PARTS = 16   # files of a day's partial: so many tasks write it


def _part():
    return F.pmod(F.xxhash64(V), F.lit(PARTS)).cast("int")


def day_states(views: DataFrame, cfg: fe.FeatureConfig = fe.FeatureConfig()) -> dict[str, DataFrame]:
    """The four partial tables of joined page-view rows, with the column
    ``day``. Rows without a date are in no window and left out."""
    rows = clean_views(views).withColumn("day", parse_date(F.col(DATE))).where("day IS NOT NULL")
    fixed = F.col(TIME).cast("decimal(38,12)")
    utc = epoch_to_utc(VS)
    hours = business_hours(F.hour(utc))
    at_home = F.col("country").eqNullSafe(F.lit(cfg.home_country))
    plain = [c for c in COLUMNS if c in views.columns]
    own = rows.groupBy("day", V, *plain, at_home.alias("home"), hours.alias("away"),
                       business_hours(F.hour(to_local(utc, cfg.home_zone))).alias("local")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum(PV).alias("views"), F.sum(fixed).alias("time"))

    def entry(column: str, raw) -> F.Column:
        return F.struct(F.lit(column).alias("column"), raw.cast("string").alias("raw"))

    entries = F.array(*[entry(c, F.col(c)) for c in plain], entry("weekpart", weekpart(F.col("day"))),
                      entry("day_name", day_name(F.col("day"))), entry("day_of_month", F.dayofmonth("day")),
                      F.when(F.col("home"), entry(AWAY, F.col("away"))).otherwise(entry("business_hours", F.col("away"))),
                      F.when(F.col("home"), entry(AT_HOME, F.col("local"))))
    # Combinations move once, before they are taken apart by column.
    cats = own.withColumn("part", _part()).repartition("day", "part") \
        .select("day", "part", V, "n", "views", "time", F.explode(entries).alias("e")) \
        .where(F.col("e").isNotNull() & (F.col("e.raw").isNotNull() | F.col("e.column").isin(*cfg.collapse_columns))) \
        .groupBy("day", "part", V, F.col("e.column").alias("column"), F.col("e.raw").alias("raw")) \
        .agg(F.sum("n").alias("n"), F.sum("views").alias("views"), F.sum("time").alias("time")).drop("part")
    known = rows.where(F.col(V).isNotNull())
    count = F.count(F.lit(1)).alias("n")
    return {
        "cats": cats,
        "pages": known.where(F.col(VS).isNotNull() & F.col(PATH).isNotNull()).groupBy("day", V, VS, PATH, PV)
        .agg(count, F.sum(fixed).alias("time")),
        "sentiment": known.groupBy("day", V, F.col(SENT).cast("double").alias("score")).agg(count),
        "paths": rows.where(F.col(PATH).isNotNull()).groupBy("day", PATH, CONTENT, PUB).agg(count)}


def write_days(views: DataFrame, root: str, cfg: fe.FeatureConfig = fe.FeatureConfig()) -> None:
    """Stores the partials of all days in ``views`` under ``root``, replacing
    those days: give a day's rows whole. A repeated run changes nothing."""
    for name, df in day_states(views, cfg).items():
        if name != "cats":  # those are by day and part of the visitors already
            df = df.repartition("day", F.pmod(F.xxhash64(KEYS[name][0]), F.lit(PARTS)))
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("day").parquet(os.path.join(root, "days", name))


def days_of(spark: SparkSession, root: str, name: str, spans: list[tuple[dt.date, dt.date]]) -> DataFrame:
    """The stored partials of the days in ``spans`` (first, last): only their
    folders are read."""
    inside = F.lit(False)
    for first, last in spans:
        inside |= F.col("day").between(F.lit(first), F.lit(last))
    return spark.read.parquet(os.path.join(root, "days", name)).where(inside)


def merged(name: str, parts: list[tuple[int, DataFrame]]) -> DataFrame:
    """The sum of signed partials of table ``name``, without keys that have
    no row left."""
    both = None
    for sign, df in parts:
        one = df.select(*KEYS[name], *[(F.col(c) * F.lit(sign)).cast(df.schema[c].dataType).alias(c) for c in SUMS[name]])
        both = one if both is None else both.unionByName(one)
    return both.groupBy(*KEYS[name]).agg(*[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in SUMS[name]]).where("n > 0")


def outside(a: tuple[dt.date, dt.date], b: tuple[dt.date, dt.date]) -> list[tuple[dt.date, dt.date]]:
    """The spans of window ``a`` that are not in window ``b``."""
    one = dt.timedelta(days=1)
    spans = [(a[0], min(a[1], b[0] - one)), (max(a[0], b[1] + one), a[1])]
    return [(x, y) for x, y in spans if x <= y]


def _path(root: str, window: tuple[dt.date, dt.date]) -> str:
    return os.path.join(root, "windows", f"{window[0]}_{window[1]}")


def _store(spark: SparkSession, root: str, window, tables: dict[str, DataFrame]) -> None:
    """Tables first, then the mark that readers ask for."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(_path(root, window), name))
    spark.createDataFrame([tuple(map(str, window))], "first string, last string").coalesce(1) \
        .write.mode("overwrite").parquet(os.path.join(_path(root, window), "complete"))


def window_state(spark: SparkSession, root: str, first, last) -> dict[str, DataFrame]:
    """The stored state of a window; raises if it was never completed."""
    window = _day(first), _day(last)
    spark.read.parquet(os.path.join(_path(root, window), "complete"))
    return {name: spark.read.parquet(os.path.join(_path(root, window), name)) for name in KEYS}


def open_window(spark: SparkSession, root: str, first, last) -> None:
    """Stores the state of the window from ``first`` to ``last`` (ends
    included), built from its days. Days without rows need no partial."""
    window = _day(first), _day(last)
    _store(spark, root, window, {n: merged(n, [(1, days_of(spark, root, n, [window]))]) for n in KEYS})


def move_window(spark: SparkSession, root: str, old: tuple, new: tuple) -> None:
    """Stores the state of window ``new`` from that of ``old`` and the days
    in which they differ; forwards, backwards, longer or shorter. A day that
    was written anew since ``old`` needs ``open_window``."""
    old, new = tuple(map(_day, old)), tuple(map(_day, new))
    state = window_state(spark, root, *old)
    added, gone = outside(new, old), outside(old, new)
    _store(spark, root, new, {
        n: merged(n, [(1, state[n]), *[(1, days_of(spark, root, n, added))] * bool(added),
                      *[(-1, days_of(spark, root, n, gone))] * bool(gone)]) for n in KEYS})


def window_features(spark: SparkSession, root: str, first, last, cfg: fe.FeatureConfig = fe.FeatureConfig()) -> DataFrame:
    """The wide feature rows of a stored window: what ``features.build_wide``
    gives for the window's page views."""
    state = window_state(spark, root, first, last)
    cats = state["cats"]
    totals = cats.where(F.col("column").isin(*cfg.collapse_columns) & F.col("raw").isNotNull()) \
        .groupBy("column", "raw").agg(F.sum("views").alias("total"))
    order = Window.partitionBy("column").orderBy(F.desc("total"), F.asc("raw"))
    tops: dict[str, list] = {c: [] for c in cfg.collapse_columns}
    for r in totals.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= cfg.top_n).collect():  # top_n a column
        tops[r["column"]].append(r["raw"])
    raw = F.col("raw")
    for c in cfg.collapse_columns:
        raw = F.when(F.col("column") == c, collapse(F.col("raw"), tops[c], cfg.other)).otherwise(raw)
    home = cfg.home_country in tops["country"] if "country" in tops else True
    column = F.when(F.col("column") == (AT_HOME if home else AWAY), "business_hours").otherwise(F.col("column"))
    at = F.array_position(F.array(*map(F.lit, COLUMNS)), column) - 1
    sums = cats.where(F.col(V).isNotNull()).select(V, at.cast("int").alias("column"), raw.alias("raw"), "views", "time") \
        .where("column >= 0 AND raw IS NOT NULL").groupBy(V, "column", "raw").agg(F.sum("views").alias("_pv"), F.sum("time").alias("_t"))
    sums = materialize(sums, "rolling-sums")
    has = lambda c: F.count(F.when((F.col("column") == c) & F.col("raw").isNotNull(), 1))
    pages = state["pages"].groupBy(V, VS, PATH).agg(F.max(PV).alias(PV), F.sum("time").cast("double").alias(TIME))
    newest = Window.partitionBy(PATH).orderBy(F.desc_nulls_last(PUB), F.asc(CONTENT))
    content = materialize(state["paths"].withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "n"), "rolling-paths")
    eligible = cats.where(F.col(V).isNotNull()).groupBy(V).agg(has("referral_group").alias("_rf"), has("device_os").alias("_dos")) \
        .where("_rf > 0 AND _dos > 0").select(V)
    scores = state["sentiment"]
    exact = F.sum(F.col("score").cast("decimal(24,12)") * F.col("n").cast("decimal(12,0)")).cast("double")
    means = scores.groupBy(V).agg((exact / F.sum(F.when(F.col("score").isNotNull(), F.col("n")))).alias("sentiment_score_mean"))
    sess = fe.session_stats(fe.session_grain(pages, content, cfg), cfg.approx_median)
    medians = fe.median_of_counts(scores.select(V, F.col("score").alias("_v"), F.col("n").alias("_c")))
    return fe.wide_row(fe.features_of_sums(sums, fe.FAMILIES, cfg), fe.names_of(sums.select("column", "raw").distinct()),
                       eligible, means, sess, medians)
