"""Profiling: null counts, shape, distinct keys — each one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """Long form (column_name, n_null), one aggregate over all columns."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_null")


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def distinct_count(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Exact distinct count (``approx=True``: HyperLogLog++ sketch)."""
    c = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(c.alias(f"n_distinct_{col}"))


def schema(df: DataFrame) -> DataFrame:
    """Position, name and type of each column."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, type string")


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(*order).limit(n)
