"""Shared scratch tables, used to cut lineage and to fix one evaluation of a plan.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a local session
without it gets a fresh temporary folder; on a cluster that would be another folder on
every machine, so it is an error there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/starmart/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader of that table.

    Later branches read the same rows even if executors are lost, and each
    branch reads only the columns it needs.  Zstandard takes about two thirds of Snappy's bytes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
