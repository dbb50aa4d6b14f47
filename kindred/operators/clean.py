"""Row cleaning, null policy and top-n category collapse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.text import blank_to_other


def drop_null_content(df: DataFrame, key: str = "content_id") -> DataFrame:
    """Rows without a content id carry no feature signal and are dropped."""
    return df.na.drop(subset=[key])


def fill_nulls(df: DataFrame, numeric=0, string: str | None = None,
               subset: list[str] | None = None) -> DataFrame:
    """Fill numeric nulls with ``numeric``; strings only when ``string`` is given."""
    cols = subset or df.columns
    num = [f.name for f in df.schema.fields
           if f.name in cols and isinstance(f.dataType, T.NumericType)]
    out = df.na.fill(numeric, subset=num) if num else df
    if string is not None:
        strs = [f.name for f in df.schema.fields
                if f.name in cols and isinstance(f.dataType, T.StringType)]
        if strs:
            out = out.na.fill(string, subset=strs)
    return out


def clean_views(df: DataFrame, time_col: str = "time_on_page",
                sentiment_col: str = "sentiment_score", tier_col: str = "tier1",
                content_col: str = "content_id") -> DataFrame:
    """The cleaning prefix of the feature build: drop rows without content,
    zero-fill time and sentiment, map blank tier-1 categories to ``other``."""
    return (drop_null_content(df, content_col)
            .withColumn(time_col, F.coalesce(F.col(time_col), F.lit(0.0)))
            .withColumn(sentiment_col, F.coalesce(F.col(sentiment_col), F.lit(0.0)))
            .withColumn(tier_col, blank_to_other(tier_col)))


def top_n(df: DataFrame, col: str, n: int = 15, measure: str = "page_views") -> DataFrame:
    """The ``n`` categories with the most ``measure``; ties broken by name.

    Plans as a partial/final aggregate followed by ``TakeOrderedAndProject``,
    so at most ``n`` rows per partition reach the final task.
    """
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.sum(measure).alias("total_views"))
            .orderBy(F.desc("total_views"), F.asc(col))
            .limit(n))


def collapse(col: str | Column, keep: list[str], other: str = "other") -> Column:
    """Values outside ``keep`` (null included) become ``other``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(keep)), c).otherwise(F.lit(other))


def top_categories(df: DataFrame, columns: list[str], n: int = 15, measure: str = "page_views") -> DataFrame:
    """``dimension, category`` of the ``n`` categories of each column with the
    most ``measure``, in that order; ties by name, nulls left out.

    One pass: the columns are stacked and aggregated together, and the rank
    limit is applied in every task before the few rows left are ranked.
    """
    each = df.select(F.col(measure).alias("_m"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("category")) for c in columns])).alias("_e"))
    totals = (each.where(F.col("_e.category").isNotNull())
              .groupBy(F.col("_e.dimension").alias("dimension"), F.col("_e.category").alias("category"))
              .agg(F.sum("_m").alias("_total")))
    order = Window.partitionBy("dimension").orderBy(F.desc("_total"), F.asc("category"))
    return (totals.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n)
            .orderBy("dimension", "_n").select("dimension", "category"))
