"""Audience sizes and overlaps from theta sketches.

A state holds at most ``2 ** lg`` hashes of ids, however many ids it has
seen; states of days merge into the state of a window, and two states give
the sizes of union, intersection and difference without the ids. Up to
``2 ** lg`` distinct ids the sizes are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rse(lg: int) -> float:
    """Relative standard error of a size, and the standard error of an
    intersection or difference as a share of the union."""
    return 2.0 ** (-lg / 2)


def states(rows: DataFrame, keys: list[str], id_col: str, lg: int = 12) -> DataFrame:
    """``keys, state``: one sketch of the non-null ids by key. Keys whose ids
    are all null have an empty state; no rows, no state."""
    return rows.groupBy(*keys).agg(F.theta_sketch_agg(F.col(id_col), F.lit(lg)).alias("state"))


def merge(parts: DataFrame, keys: list[str], lg: int = 12) -> DataFrame:
    """The states of ``parts`` merged by ``keys``."""
    return parts.groupBy(*keys).agg(F.theta_union_agg("state", F.lit(lg)).alias("state"))


def size(state: str | Column) -> Column:
    """The estimated number of distinct ids."""
    return F.theta_sketch_estimate(F.col(state) if isinstance(state, str) else state)


def overlap(left: str, right: str, lg: int = 12) -> list[Column]:
    """``either, both, left_only, right_only`` of two state columns (long)."""
    return [size(F.theta_union(F.col(left), F.col(right), F.lit(lg))).alias("either"),
            size(F.theta_intersection(F.col(left), F.col(right))).alias("both"),
            size(F.theta_difference(F.col(left), F.col(right))).alias("left_only"),
            size(F.theta_difference(F.col(right), F.col(left))).alias("right_only")]


def within(estimate: str | Column, exact: str | Column, union: str | Column, lg: int, errors: float = 5.0) -> Column:
    """Whether an estimate is within ``errors`` standard errors of the exact
    number (five are missed about once in two million)."""
    est, ex, un = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact, union))
    return F.abs(est - ex) <= F.lit(errors * rse(lg)) * un
