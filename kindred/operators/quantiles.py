"""Medians from mergeable sketches (KLL), stored as states.

A state is bounded by its size parameter ``k`` however many values it has
seen, and states of parts (days, partitions, sites) merge into the state of
the whole, which a percentile buffer inside one aggregate cannot do across
jobs. With up to ``k`` values a state holds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_error(k: int) -> float:
    """By how much the rank of an estimate may be off, as a share of the
    values, in 99 of 100 cases (published bound of KLL sketches)."""
    return 2.296 / k ** 0.9723


def states(rows: DataFrame, keys: list[str], value: str, k: int = 200) -> DataFrame:
    """``keys, n, state``: one sketch of the non-null, non-NaN ``value`` by
    key; keys without a value have no row."""
    v = F.col(value).cast("double")
    return rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("state"))


def merge(parts: DataFrame, keys: list[str], k: int = 200) -> DataFrame:
    """The states of ``parts`` merged by ``keys``."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("state", F.lit(k)).alias("state"))


def quantile(state: str | Column, p: float) -> Column:
    """The value at rank ``p`` (0 to 1)."""
    return F.kll_sketch_get_quantile_double(F.col(state) if isinstance(state, str) else state, F.lit(p))


def exact_bounds(rows: DataFrame, keys: list[str], value: str, low: float, high: float) -> DataFrame:
    """``keys, low, high``: the exact values at two ranks, from value counts
    in sorted order (they spill; no buffer of a key's values)."""
    v = F.col(value).cast("double")
    counts = rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    by = Window.partitionBy(*keys)
    upto = F.sum("_c").over(by.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto).withColumn("_all", F.sum("_c").over(by))

    def at(p: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1.0), F.col("_all") * F.lit(p)), F.col("_v")))

    return ranked.groupBy(*keys).agg(at(low).alias("low"), at(high).alias("high"))
