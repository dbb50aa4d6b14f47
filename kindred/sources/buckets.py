"""Tables bucketed by a key: a join of two such tables on it, or a group by
it, needs no exchange.

A table is a folder of parquet files, one a bucket and sorted by the key
inside, with a description beside them that any session can read it from.
The catalog entry is made from the description, so a session without a
shared catalog plans the same joins. All rows of a key go to one task when
a table is written: store what has a bounded number of rows by key (features,
labels, scores, sums by category), not the raw rows of a hot visitor.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from kindred.sources.sinks import _files

SPEC = "_buckets.json"  # a name that readers of the parquet files pass over


def bucket_count(spark: SparkSession) -> int:
    """Buckets of new tables: the session's shuffle partitions. Tables that
    are to be joined need the same number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_spec(spark: SparkSession, path: str) -> dict | None:
    """The description of the table at ``path``; None if there is none."""
    fs, root = _files(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path(root, SPEC)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Replace the table at ``path`` by ``df`` bucketed and sorted by ``key``;
    the table read back.

    The description is written last: a write that stops before it leaves a
    folder that ``read_bucketed`` refuses. ``df`` must not read ``path``.
    Rows with a null key are kept, in one bucket.
    """
    spark, n = df.sparkSession, buckets or bucket_count(df.sparkSession)
    fs, root = _files(spark, path)
    before = read_spec(spark, path)
    if before:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(before['name'])}")
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, SPEC), False)
    name = f"bucketed_{uuid.uuid4().hex}"
    # One task a bucket, so one file a bucket.
    df.repartition(n, _quoted(key)).write.mode("overwrite").bucketBy(n, key).sortBy(key) \
        .option("path", root.toString()).saveAsTable(name)
    table = spark.table(name)
    spec = {"name": name, "key": key, "buckets": n, "columns": table.schema.toDDL()}
    stream = fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, SPEC), True)
    stream.write(json.dumps(spec).encode())
    stream.close()
    return table


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, entered in the session's catalog if it is not.
    Raises if no whole table is there."""
    spec = read_spec(spark, path)
    if spec is None:
        raise ValueError(f"no bucketed table at {path}")
    _, root = _files(spark, path)
    key = _quoted(spec["key"])
    location = root.toString().replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(spec['name'])} ({spec['columns']}) USING parquet "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {spec['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(spec["name"])
