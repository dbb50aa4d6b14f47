"""Population comparison: class mix per category, shares, average ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.features import exact_sum, ratio

# Class texts of the two populations.
C_LEVEL, NON_C_LEVEL = "C-level", "Non-Clevel"

DIMENSIONS = ["tier1", "channel", "device_category", "section", "device_os",
              "device_browser", "country", "referral_group"]


def class_from_label(level_col: str = "management_level", positive: str = "C-Level"):
    return F.when(F.col(level_col) == positive, F.lit(C_LEVEL)).otherwise(F.lit(NON_C_LEVEL))


def class_from_prediction(pred_col: str = "predicted"):
    return F.when(F.col(pred_col) == 1, F.lit(C_LEVEL)).otherwise(F.lit(NON_C_LEVEL))


def average_rank_desc(value: str, partition: list[str]) -> "F.Column":
    """Descending rank with ties given their average rank, truncated to int."""
    order = Window.partitionBy(*partition).orderBy(F.desc(value))
    ties = Window.partitionBy(*partition, value)
    return (F.rank().over(order) + F.floor((F.count(F.lit(1)).over(ties) - 1) / 2)).cast("int")


def class_mix(rows: DataFrame, dims: list[str] = DIMENSIONS, cls: str = "c_level",
              measure: str = "page_views") -> DataFrame:
    """Per (dimension, category): share (in %) of each class's views and the
    average rank of each share inside the dimension.

    All dimensions are folded into one pass by stacking them; the shares
    and ranks are windows over the aggregated (small) category table.
    """
    stacked = _stacked(rows.select(F.col(cls).alias("_cls"), F.col(measure).alias("_m"), *dims), dims, "_cls", "_m")
    return mix_of_views(stacked, "_cls", "_m")


def _stacked(rows: DataFrame, dims: list[str], *keep: str) -> DataFrame:
    """``keep, dimension, category``: a row for each non-null category."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("category")) for d in dims]))
    return rows.select(*keep, each.alias("_e")).where("_e.category IS NOT NULL").select(*keep, "_e.dimension", "_e.category")


def visitor_views(rows: DataFrame, dims: list[str] = DIMENSIONS, measure: str = "page_views",
                  key: str = "visitor_id") -> DataFrame:
    """``visitor_id, dimension, category`` and the summed ``measure``: what
    ``mix_of_views`` needs of a visitor, at most a row for each category.
    Rows are summed in their own tasks first, so a hot visitor costs a row
    for each of its categories and task. Rows without a visitor are left out."""
    sums = rows.where(F.col(key).isNotNull()).groupBy(key, *dims).agg(F.sum(measure).alias(measure))
    return _stacked(sums, dims, key, measure).groupBy(key, "dimension", "category").agg(F.sum(measure).alias(measure))


def mix_of_views(views: DataFrame, cls: str = "c_level", measure: str = "page_views") -> DataFrame:
    """``class_mix`` of rows or sums ``dimension, category, cls, measure``."""
    agg = (views.groupBy("dimension", "category")
           .agg(F.coalesce(F.sum(F.when(F.col(cls) == C_LEVEL, F.col(measure))), F.lit(0)).alias("_c"),
                F.coalesce(F.sum(F.when(F.col(cls) == NON_C_LEVEL, F.col(measure))), F.lit(0)).alias("_n")))
    dim = Window.partitionBy("dimension")
    shares = agg.select(
        "dimension", "category",
        (F.coalesce(F.try_divide(F.col("_c"), F.sum("_c").over(dim)), F.lit(0.0)) * 100).alias("c_level_share"),
        (F.coalesce(F.try_divide(F.col("_n"), F.sum("_n").over(dim)), F.lit(0.0)) * 100).alias("non_c_level_share"))
    return (shares
            .withColumn("c_rank", average_rank_desc("c_level_share", ["dimension"]))
            .withColumn("nonc_rank", average_rank_desc("non_c_level_share", ["dimension"])))


def compare_populations(train: DataFrame, pred: DataFrame) -> DataFrame:
    """Inner join of two class-mix summaries with ``_train``/``_pred`` suffixes."""
    keys = ["dimension", "category"]
    t = train.select(*keys, *[F.col(c).alias(c + "_train") for c in train.columns if c not in keys])
    p = pred.select(*keys, *[F.col(c).alias(c + "_pred") for c in pred.columns if c not in keys])
    return t.join(p, keys, "inner")


def top_k_by_rank(summary: DataFrame, k_by_dimension: dict, rank_col: str = "c_rank_pred") -> DataFrame:
    """First ``k`` categories per dimension in ``rank_col`` order (name breaks ties)."""
    w = Window.partitionBy("dimension").orderBy(F.col(rank_col), F.col("category"))
    ks = F.create_map(*[x for d, k in k_by_dimension.items() for x in (F.lit(d), F.lit(k))])
    return (summary.withColumn("_pos", F.row_number().over(w))
            .where(F.col("_pos") <= F.coalesce(ks[F.col("dimension")], F.lit(2 ** 31 - 1)))
            .drop("_pos"))


def class_avg_time(train: DataFrame, pred: DataFrame, cls: str = "c_level") -> DataFrame:
    """Average time per view by class, both populations side by side."""
    def one(df, suffix):
        return (df.groupBy(cls).agg(ratio(exact_sum("time_on_page"), F.sum("page_views"))
                                    .alias("avg_time_on_page" + suffix)))
    return one(train, "_train").join(one(pred, "_pred"), cls, "inner")


def class_time_pivot(rows: DataFrame, cls: str = "c_level") -> DataFrame:
    """Views by time-on-page value and class (absent = 0)."""
    return (rows.where(F.col("time_on_page").isNotNull()).groupBy("time_on_page")
            .agg(F.coalesce(F.sum(F.when(F.col(cls) == C_LEVEL, F.col("page_views"))), F.lit(0)).alias("c_level_pvs"),
                 F.coalesce(F.sum(F.when(F.col(cls) == NON_C_LEVEL, F.col("page_views"))), F.lit(0)).alias("non_c_level_pvs")))


def class_counts(df: DataFrame, col: str = "c_level") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, col: str = "c_level") -> DataFrame:
    counts = class_counts(df, col)
    return counts.select(col, (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))
