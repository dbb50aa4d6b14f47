"""Sinks: write a DataFrame as a table, replacing or appending.

Errors raise (a failed write must fail the job). Parquet files are
committed by Spark's file commit protocol, so a lost executor's partial
output is never visible.

``write_table`` is the plain form: an append that is retried writes twice.
``append_run`` loads a run once or not at all. A table of runs is a folder

    data/_attempt=<id>/     what one attempt wrote
    commits/<name>.json     which attempt counts for a run

and ``read_runs`` reads only the attempts that a commit names, so a run
stopped before its commit changes nothing, and what it wrote is never read.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMIT = "run string, attempt string, generation long, fields string, schema string"


def write_table(df: DataFrame, path: str, replace: bool = False,
                partition_by: list[str] | None = None) -> None:
    """Append to (default) or replace the parquet table at ``path``."""
    w = df.write.mode("overwrite" if replace else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and its qualified form."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def commits(spark: SparkSession, path: str) -> list:
    """The committed runs, one small row each."""
    fs, _ = _files(spark, path)
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")):
        return []
    return spark.read.schema(COMMIT).json(f"{path}/commits").collect()


def _publish(spark: SparkSession, path: str, name: str, content: dict) -> bool:
    """Put a commit in place whole; False if one of that name is there. The
    rename refuses an existing target, on HDFS as one step; a store without
    such a rename allows one writer of a run at a time."""
    jvm = spark._jvm
    fs, root = _files(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}/staging/{uuid.uuid4().hex}.json")
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{name}.json")
    fs.mkdirs(target.getParent())
    stream = fs.create(new, False)
    stream.write(json.dumps(content).encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(new), fs.makeQualified(target), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
            raise
        return False
    return True


def append_run(df: DataFrame, path: str, run_id: str, replace: bool = False,
               partition_by: list[str] | None = None) -> bool:
    """Load ``df`` into the table of runs at ``path`` under ``run_id``; False
    if that run was loaded before, and then nothing changes.

    With ``replace`` the table holds this run alone once it is committed;
    runs that began before the replacement and commit after it are replaced
    too. A run id that was replaced stays used. Columns must have the names
    and types, and the partition columns, of the runs that the table holds.
    """
    spark, done = df.sparkSession, commits(df.sparkSession, path)
    if any(c.run == run_id for c in done):
        return False
    if "_attempt" in (c.lower() for c in df.columns):
        raise ValueError("_attempt is the name of a folder level here")
    fields = json.dumps([sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields), partition_by or []])
    now = max((c.generation for c in done), default=0)
    if not replace and any(c.fields != fields for c in done if c.generation == now):
        raise ValueError(f"columns or partition columns differ from those of the table at {path}")
    attempt = uuid.uuid4().hex
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.parquet(f"{path}/data/_attempt={attempt}")
    # The order of the columns is that of the runs that the table holds.
    like = [] if replace else [c.schema for c in done if c.generation == now]
    entry = {"run": run_id, "attempt": attempt, "fields": fields, "schema": like[0] if like else df.schema.json()}
    if not replace:
        return _publish(spark, path, "run-" + hashlib.sha256(run_id.encode()).hexdigest(), {**entry, "generation": now})
    while not _publish(spark, path, f"generation-{now + 1}", {**entry, "generation": now + 1}):
        done = commits(spark, path)
        if any(c.run == run_id for c in done):
            return False
        now = max(c.generation for c in done)
    return True


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the committed runs. Raises if there is none."""
    done = commits(spark, path)
    if not done:
        raise ValueError(f"no committed run at {path}")
    now = max(c.generation for c in done)
    live = sorted((c for c in done if c.generation == now), key=lambda c: c.attempt)
    schema = T.StructType.fromJson(json.loads(live[0].schema))
    rows = spark.read.schema(schema).option("basePath", f"{path}/data")
    return rows.parquet(*[f"{path}/data/_attempt={c.attempt}" for c in live]).select(
        *["`" + f.name.replace("`", "``") + "`" for f in schema.fields])
