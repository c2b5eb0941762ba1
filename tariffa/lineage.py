"""Cuts of lineage in a folder that all machines see."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset a temporary one in local mode, an error on a cluster."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp())
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept, so that what reads it twice reads the same rows and a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
