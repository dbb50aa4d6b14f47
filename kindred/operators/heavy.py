"""Heavy hitters from bounded states (weighted Misra-Gries), with merge.

A state of a column holds at most ``k`` categories with a weight each, and an
error. A category's true weight lies between its weight in the state (0 if it
is not there) and that plus the error, and the error is at most the total
weight / (k + 1). So every category above that share is in the state, and
the state's size does not depend on the number of categories. Each task folds
its rows into one state, so only states are shuffled.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.clean import top_categories
from kindred.sources.session import materialize

COUNTERS = "array<struct<category:string,weight:bigint>>"


def _folded(table: pa.Table) -> pa.Table:
    return table.group_by("category").aggregate([("weight", "sum")]).rename_columns(["category", "weight"])


def _shrunk(table: pa.Table, k: int) -> tuple[pa.Table, int]:
    """At most ``k`` counters: each less the (k + 1)-th largest weight, and that weight."""
    if table.num_rows <= k:
        return table, 0
    order = pc.sort_indices(table.column("weight"), sort_keys=[("", "descending")])
    cut = table.column("weight")[order[k].as_py()].as_py()
    table = table.set_column(1, "weight", pc.subtract(table.column("weight"), cut))
    return table.filter(pc.greater(table.column("weight"), 0)), cut


def states(df: DataFrame, columns: list[str], measure: str = "page_views", k: int = 1024) -> DataFrame:
    """``dimension, total, error, counters``: one state by task and column.

    Null categories are left out, a null measure weighs 0. The measure must
    be of an integral type; a negative weight raises. Without rows there is
    no state.
    """
    if not isinstance(df.schema[measure].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{measure} must be of an integral type")
    shape = pa.list_(pa.struct([("category", pa.string()), ("weight", pa.int64())]))

    def run(batches):
        empty = pa.table({"category": pa.array([], pa.string()), "weight": pa.array([], pa.int64())})
        held = [(empty, 0, 0) for _ in columns]
        for b in batches:
            weight = b.column("w")
            if b.num_rows and pc.min(weight).as_py() < 0:
                raise ValueError("negative weight")
            for i, (have, total, error) in enumerate(held):
                rows = pa.table({"category": b.column(f"c{i}").cast(pa.string()), "weight": weight})
                rows = rows.filter(pc.is_valid(rows.column("category")))
                total += pc.sum(rows.column("weight")).as_py() or 0
                have = _folded(pa.concat_tables([have, _folded(rows)]))
                if have.num_rows > 4 * k:
                    have, cut = _shrunk(have, k)
                    error += cut
                held[i] = have, total, error
        for name, (have, total, error) in zip(columns, held):
            have, cut = _shrunk(have, k)
            if have.num_rows or total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([total], pa.int64()), pa.array([error + cut], pa.int64()),
                     pa.array([have.to_pylist()], shape)], ["dimension", "total", "error", "counters"])

    rows = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)],
                     F.coalesce(F.col(measure).cast("long"), F.lit(0)).alias("w"))
    return rows.mapInArrow(run, f"dimension string, total long, error long, counters {COUNTERS}")


def merge(parts: DataFrame, k: int = 1024, keys: list[str] | None = None) -> DataFrame:
    """The states of ``parts`` merged by ``keys`` (default: the dimension),
    with at most ``k`` counters again; ``k`` not above that of the parts.

    Weights are added by category, and the rank limit is applied in every
    task, so k + 1 rows of a task at most meet in one.
    """
    keys = keys or ["dimension"]
    sums = parts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("error").alias("_before"))
    each = (parts.select(*keys, F.explode("counters").alias("_c")).groupBy(*keys, F.col("_c.category").alias("category"))
            .agg(F.sum("_c.weight").alias("weight")))
    order = Window.partitionBy(*keys).orderBy(F.desc("weight"), F.asc("category"))
    first = each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    full = first.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("_n") == k + 1, F.col("weight"))), F.lit(0)).alias("_cut"), F.max("_n").alias("_most"),
        F.sort_array(F.collect_list(F.struct("_n", "category", "weight"))).alias("_all"))
    left = F.transform("_all", lambda c: F.struct(c["category"].alias("category"), (c["weight"] - F.col("_cut")).alias("weight")))
    kept = F.when(F.col("_most") <= k, left).otherwise(F.filter(left, lambda c: c["weight"] > 0))
    none = F.array().cast(COUNTERS)
    out = sums.join(full.select(*[F.col(c).alias(f"_{c}_k") for c in keys], "_cut", kept.alias("counters")),
                    [F.col(c).eqNullSafe(F.col(f"_{c}_k")) for c in keys], "left")
    return out.select(*keys, "total", (F.col("_before") + F.coalesce("_cut", F.lit(0))).alias("error"),
                      F.coalesce("counters", none).alias("counters"))


def top_n(df: DataFrame, columns: list[str], n: int = 15, measure: str = "page_views", k: int = 1024) -> DataFrame:
    """As ``clean.top_categories``, without a shuffle of all categories: the
    candidates of the merged states are summed exactly, and the result stands
    if the n-th sum is above the state's error. Columns for which that does
    not hold (a flat distribution) take the full aggregate."""
    state = materialize(merge(states(df, columns, measure, k), k), "heavy")
    cands = state.select(F.col("dimension").alias("_d"), F.explode("counters").alias("_c")).select("_d", F.col("_c.category").alias("_k"))
    each = df.select(F.col(measure).alias("_m"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("category")) for c in columns])).alias("_e"))
    # At most k candidates a column, whatever the data.
    mine = each.select("_m", "_e.*").join(F.broadcast(cands), (F.col("dimension") == F.col("_d")) & (F.col("category") == F.col("_k")), "left_semi")
    sums = mine.groupBy("dimension", "category").agg(F.sum("_m").alias("_total"))
    order = Window.partitionBy("dimension").orderBy(F.desc("_total"), F.asc("category"))
    best = materialize(sums.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n), "heavy-top")
    last = best.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("_total", F.lit(0))).alias("least"))
    sure = state.select("dimension", "error").join(last, "dimension", "left").where(
        f"error = 0 OR (n = {int(n)} AND least > error)")
    known = {r["dimension"] for r in sure.select("dimension").collect()}  # one row a column
    rest = [c for c in columns if c not in known]
    out = best.where(F.col("dimension").isin(list(known)))
    if rest:
        full = top_categories(df, rest, n, measure)
        out = out.select("dimension", "category").unionByName(full)
    return out.select("dimension", "category")
