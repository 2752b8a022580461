"""Results that several later steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session without it gets a temporary one, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named or sc.getCheckpointDir():
        return named or sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="larder-checkpoint-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """df computed once and cut from its lineage, by checkpoint() in the shared folder."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint()
