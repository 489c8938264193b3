"""Cutting lineage between the rounds of an iterative job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in the session.

    Only a local-mode session may fall back to a folder on this machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="pressloom-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor never replays earlier rounds."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
