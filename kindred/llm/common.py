"""Helpers shared by the operators: tables and connected components.

``staged`` writes a frame under a fresh path of the shared checkpoint folder
and reads it back; a lost executor then costs a re-read of one file."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.session import materialize as staged  # noqa: F401

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it,
    whatever folder the session was started in. Where executors have no such
    path, ship the package with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """What runs inside gets ``rows`` rows a batch in Python workers: of whole
    texts Spark's default, 10 000, is held several times by a task outside its
    heap. A size set by the deployment stays."""
    before = spark.conf.get(BATCH, "10000")
    if before == "10000":
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha_list(values, sep: str = ",") -> "F.Column":
    """Lower-case hex SHA-256 of an array of strings joined by ``sep``."""
    return F.sha2(F.concat_ws(sep, values), 256)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected graph in ``edges(a, b)``.

    Returns ``(node, root)`` for every node that has an edge to another
    one; the root is the smallest node of the component. Alternates
    large-star and small-star rounds; every half round is a stored table.
    A node's neighbours are never gathered: each half round is a partially
    aggregated minimum per node and a join back to stored edges, which
    adaptive execution can split where one node holds many edges.
    """
    e = staged(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "cc")
    state = None
    while True:
        both = e.unionByName(e.selectExpr("v AS u", "u AS v"))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m"))
                     .select("u", F.least("u", "m").alias("m")), "cc")
        e = staged(both.where("v > u").join(low, "u").selectExpr("v AS u", "m AS v")
                   .where("u <> v").distinct(), "cc")
        low = staged(e.groupBy("u").agg(F.min("v").alias("m")), "cc")
        e = staged(e.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
                   .unionByName(low.selectExpr("u", "m AS v"))
                   .selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                    F.countDistinct("u")).first()
        if tuple(now) == state and now[0] == now[2]:
            break
        state = tuple(now)
    return e.selectExpr("u AS node", "v AS root").unionByName(
        e.selectExpr("v AS node", "v AS root").distinct())
