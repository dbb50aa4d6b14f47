"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator, and where SQL can state it, the DuckDB oracle text.

Registered queries run on the fixture views of ``kindred.sources.fixtures``
over whole tables. Presentation for the cross-engine check: doubles are
rounded to 6 places and dates / timestamps are rendered as ISO text on
both sides (``out`` here, ``strftime``/``round`` in the SQL).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.sources.fixtures import Fixtures, duckdb_with_clause
from kindred.operators.features import FeatureConfig

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Parameters of the registered queries (fixture data: 2024-01, NATION_*, PLAN_*).
CFG = FeatureConfig(home_country="NATION_19")
RESOURCES = ["PLAN_A", "PLAN_B"]
DATE_START, DATE_END = "2024-01-01", "2024-01-21"
SAMPLE_ROWS, SAMPLE_SEED = 1000, "12345"

W = duckdb_with_clause()


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round6(c):
    """Round to 6 places the way the SQL oracle does: ``x * 1e6`` rounded
    half away from zero in binary floating point, then divided back."""
    c = c.cast("double")
    scaled = F.signum(c) * F.floor(F.abs(c) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(scaled)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def out(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places (as ``round6``); dates and timestamps as
    ISO text. Built as one SQL projection (cheap to plan for wide rows)."""
    exprs = []
    for f in df.schema.fields:
        c = _q(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            d = f"CAST({c} AS DOUBLE)"
            e = (f"CASE WHEN isnan({d}) OR abs({d}) = double('inf') THEN {d} "
                 f"ELSE signum({d}) * floor(abs({d}) * 1000000D + 0.5D) / 1000000D END")
        elif isinstance(f.dataType, T.DateType):
            e = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            e = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        else:
            e = c
        exprs.append(f"{e} AS {c}")
    return df.selectExpr(*exprs)


def unpivoted(df: DataFrame, ids: list[str]) -> DataFrame:
    """A wide frame as ``ids, feature, value``, rounded as ``out``."""
    names = [c for c in df.columns if c not in ids]
    values = F.array(*[F.col(_q(n)).cast("double") for n in names])
    rows = df.select(*ids, F.posexplode(values).alias("_at", "value"))
    labels = F.array(*[F.lit(n) for n in names])
    return out(rows.select(*ids, F.element_at(labels, F.col("_at") + 1).alias("feature"), "value"))


_SHARED: dict = {}


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    """One set of stored fixture views per session and scale directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = Fixtures(spark, sf_dir, store=True)
    return _SHARED[key]
