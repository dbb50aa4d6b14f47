"""Table access: named tables or parquet paths, column-name normalisation."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A catalog table by name, else ``<base>/<name>.parquet``, else a path."""
    if base is not None:
        return spark.read.parquet(os.path.join(base, f"{name}.parquet"))
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.parquet(name)


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case; names that collide raise."""
    lower = [c.lower() for c in df.columns]
    if len(set(lower)) != len(lower):
        dup = sorted({c for c in lower if lower.count(c) > 1})
        raise ValueError(f"lower-casing makes duplicate columns: {dup}")
    return df.toDF(*lower)


def select_except(df: DataFrame, *names: str) -> DataFrame:
    """``SELECT * EXCEPT (names)``."""
    return df.drop(*names)
