"""Repeatable row sampling and de-duplication."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.sources.session import materialize


def row_hash(id_col: str, seed: str):
    """Hex md5 of ``id|seed``; ordering by it is a seeded random order that
    does not depend on partitioning."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit("|" + str(seed))))


def sample_rows(df: DataFrame, n: int, seed: str, id_col: str = "event_id") -> DataFrame:
    """The ``n`` rows first in seeded hash order (all rows if fewer); rows of
    one id stand together.

    Rows are cut by a threshold on the leading 60 bits of the hash, chosen
    so that a little more than ``n`` pass, and what passes is stored. It is
    a prefix of the order, so if it holds ``n`` rows the result is exact;
    else all rows are ranked. Only hashes are sorted to find the last one.
    """
    total = df.count()
    keyed = df.withColumn("_h", row_hash(id_col, seed))
    if total <= n:
        return df
    frac = (n + 6 * math.sqrt(n) + 64) / total
    if frac < 1.0:
        lead = F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")
        some = materialize(keyed.where(lead < F.lit(int(frac * (1 << 60)))), "sample")
        keyed = some if some.count() >= n else keyed
    last = keyed.select("_h").orderBy("_h").limit(n).agg(F.max("_h")).first()[0]
    return keyed.where(F.col("_h") <= F.lit(last)).drop("_h")


def slot_size(n: int, slots: int) -> int:
    """Rows a slot keeps: its share of the first ``n`` and six standard deviations."""
    return math.ceil(n / slots + 6 * math.sqrt(n / slots) + 64)


def _first_of_slots(keyed: DataFrame, n: int, slots: int) -> DataFrame:
    order = Window.partitionBy("_slot").orderBy("_h")
    return keyed.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= slot_size(n, slots)).drop("_n")


def sample_state(df: DataFrame, n: int, seed: str, id_col: str = "event_id", slots: int = 64,
                 expected: int | None = None) -> DataFrame:
    """Rows of ``df`` with ``_h`` and ``_slot``: those first in seeded hash
    order, a bounded number by slot (a part of the ids, drawn by another hash).

    One scan: the rank limit is applied in every task before the exchange.
    With ``expected`` rows known (from footers or a catalog), rows far behind
    the n-th hash are left out before that; if it was too high,
    ``sample_from`` finds the state too short. Rows without an id have no place.
    """
    keyed = df.withColumn("_h", row_hash(id_col, seed)).where("_h IS NOT NULL")
    keyed = keyed.withColumn("_slot", F.pmod(F.xxhash64("_h"), F.lit(slots)).cast("int"))
    frac = (n + 6 * math.sqrt(n) + 64) / expected if expected else 1.0
    if frac < 1.0:
        keyed = keyed.where(F.conv(F.substring("_h", 1, 15), 16, 10).cast("long") < F.lit(int(frac * (1 << 60))))
    return _first_of_slots(keyed, n, slots)


def merge_samples(a: DataFrame, b: DataFrame, n: int, slots: int = 64) -> DataFrame:
    """The state of the rows of both (days, partitions), as if seen at once."""
    return _first_of_slots(a.unionByName(b), n, slots)


def sample_from(state: DataFrame, n: int, slots: int = 64) -> DataFrame | None:
    """The ``n`` rows first in hash order, rows of one id together; None if
    the (stored) state does not hold them all: fewer than ``n`` rows, or an
    id with so many rows that its slot was cut."""
    full = state.groupBy("_slot").agg(F.count(F.lit(1)).alias("n"), F.max("_h").alias("top"))
    info = full.agg(F.sum("n").alias("n"), F.min(F.when(F.col("n") >= slot_size(n, slots), F.col("top"))).alias("limit")).first()
    if (info["n"] or 0) < n:
        return None
    last = state.select("_h").orderBy("_h").limit(n).agg(F.max("_h")).first()[0]
    if info["limit"] is not None and last >= info["limit"]:
        return None
    return state.where(F.col("_h") <= F.lit(last)).drop("_h", "_slot")


def sample_once(df: DataFrame, n: int, seed: str, id_col: str = "event_id", expected: int | None = None) -> DataFrame:
    """As ``sample_rows``, from a stored state made in one scan; what the state
    cannot decide (few rows, repeated ids) goes to ``sample_rows``."""
    if n < 1:
        return df.limit(0)
    state = materialize(sample_state(df, n, seed, id_col, expected=expected), "sample-state")
    found = sample_from(state, n)
    return sample_rows(df, n, seed, id_col) if found is None else found


def dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ascending, nulls last).

    With one order column of a fixed width, its minimum per key is a hash
    aggregate of two narrow columns, joined back; only ties are ranked.
    Else rows are ranked, with the rank limit applied in every task first.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    rows = df
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, (T.NumericType, T.DateType, T.TimestampType)):
        low = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(order[0]).alias("_low"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        rows = df.join(low, [*same, F.col(order[0]).eqNullSafe(F.col("_low"))], "left_semi")
    first = Window.partitionBy(*keys).orderBy(*by)
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
