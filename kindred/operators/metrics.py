"""Evaluation metrics as distributed aggregates: Tversky / Dice on soft
predictions, weighted F1 from confusion counts, probability histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fsum(c):
    # fixed-point accumulation: the total does not depend on row order
    return F.sum(c.cast("decimal(38,12)")).cast("double")


def overlap_sums(df: DataFrame, y: str, p: str) -> DataFrame:
    yt, yp = F.col(y).cast("double"), F.col(p).cast("double")
    return df.agg(_fsum(yt * yp).alias("tp"), _fsum(yt * (1 - yp)).alias("fn"),
                  _fsum((1 - yt) * yp).alias("fp"), _fsum(yt).alias("sum_true"),
                  _fsum(yp).alias("sum_pred"))


def tversky(df: DataFrame, y: str, p: str, smooth: float = 1.0, alpha: float = 0.7,
            gamma: float = 0.75) -> DataFrame:
    """Tversky index, its loss and the focal Tversky loss in one row."""
    s = overlap_sums(df, y, p)
    tv = (F.col("tp") + smooth) / (F.col("tp") + alpha * F.col("fn")
                                   + (1 - alpha) * F.col("fp") + smooth)
    return s.select(tv.alias("tversky")).select(
        "tversky", (1 - F.col("tversky")).alias("tversky_loss"),
        F.pow(1 - F.col("tversky"), gamma).alias("focal_tversky_loss"))


def dice(df: DataFrame, y: str, p: str, smooth: float = 1.0) -> DataFrame:
    s = overlap_sums(df, y, p)
    d = (2 * F.col("tp") + smooth) / (F.col("sum_true") + F.col("sum_pred") + smooth)
    return s.select(d.alias("dice")).select("dice", (1 - F.col("dice")).alias("dice_loss"))


def weighted_f1(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Support-weighted F1 over the classes seen in ``y`` or ``yhat``;
    a class with no true and no predicted rows scores 0."""
    per_row = df.select(F.explode(F.array(
        F.struct(F.col(y).alias("c"), F.lit(1).alias("s"), F.lit(0).alias("q"),
                 (F.col(y) == F.col(yhat)).cast("int").alias("tp")),
        F.struct(F.col(yhat).alias("c"), F.lit(0).alias("s"), F.lit(1).alias("q"),
                 F.lit(0).alias("tp")))).alias("e")).select("e.*")
    per_class = per_row.groupBy("c").agg(F.sum("s").alias("support"), F.sum("q").alias("predicted"),
                                         F.sum("tp").alias("tp"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), F.lit(0.0))
    return per_class.agg((F.sum(F.col("support") * f1) / F.sum("support")).alias("weighted_f1"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin.
    One row per bin, empty bins included. The range is one small aggregate
    (two numbers to the driver); the counting is a grouped aggregate."""
    v = F.col(col).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:  # numpy widens a zero-width range to [x - 0.5, x + 0.5]
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    idx = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins).cast("int"), F.lit(bins - 1))
    counts = df.where(v.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))
