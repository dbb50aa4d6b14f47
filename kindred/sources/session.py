"""Session helpers: configuration defaults and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults a production job would also set. AQE re-plans joins and
# partition counts at run time and splits skewed sort-merge partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "kindred",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to a path that the driver and
    all executors share; unset there, it raises. Only a local session takes
    a fresh folder under the system temp directory.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="kindred-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table under a fresh path of the checkpoint
    folder and read it back. Later passes read a column-pruned scan, and a
    lost executor does not send the job back to what is above. Every call
    has a path of its own, so frames of earlier calls stay readable."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_partitions(spark: SparkSession, input_bytes: int, cores: int,
                    target_bytes: int = 256 << 20, max_split_bytes: int = 128 << 20) -> int:
    """Size the shuffle for an input of ``input_bytes``.

    The initial shuffle partition count is chosen so that one partition of
    the largest shuffle (at most about the input) holds ``target_bytes``,
    but never fewer than two per core; AQE then coalesces small ones and
    splits skewed ones at run time. File splits are capped so that scan
    tasks also fit executor memory. Values already set by the deployment
    are kept. Returns the partition count in effect.
    """
    conf = spark.conf
    want = max(2 * cores, -(-int(input_bytes) // target_bytes))
    current = int(conf.get("spark.sql.shuffle.partitions", "200"))
    if want > current:
        conf.set("spark.sql.shuffle.partitions", str(want))
    if conf.get("spark.sql.files.maxPartitionBytes", None) in (None, str(128 << 20), "128m", "128MB"):
        conf.set("spark.sql.files.maxPartitionBytes", str(max_split_bytes))
    conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return int(conf.get("spark.sql.shuffle.partitions"))
