"""Session helpers: scratch space and sizes taken from the running session."""

from __future__ import annotations

import functools
import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder of its own; on a
    cluster that is an error, as a machine-local folder is lost with its executor.
    """
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a folder when the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the checkpoint folder and go on from there.

    For tables that several later steps read: they are computed once, each reader takes only the
    columns it needs, and a lost executor costs no more than reading again.
    """
    path = scratch_dir(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(staged: DataFrame) -> None:
    """Delete a table that ``stage`` wrote and that nothing reads any more."""
    spark = staged.sparkSession
    folders = {path.rsplit("/", 1)[0] for path in staged.inputFiles()}
    for folder in folders:
        if re.search(r"/stage-[0-9a-f]{12}$", folder):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession) -> int:
    """Buckets for a two-level running total: several per shuffle task, so tasks stay even."""
    return max(64, min(16_384, 8 * shuffle_partitions(spark)))


def hex_digits(spark: SparkSession) -> int:
    """Leading hex digits of a hash that give at least ``bucket_count`` buckets (at most 65,536)."""
    return min(4, math.ceil(math.log(bucket_count(spark), 16)))
