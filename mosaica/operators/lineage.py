"""Cutting the lineage of iterative jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where none is set a local master gets a temporary folder; a cluster, whose machines share
    none, gets an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            path = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed in the session's shared folder, so that a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
