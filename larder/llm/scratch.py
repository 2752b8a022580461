"""Results that cut lineage, kept as Parquet in the shared folder of spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from larder.llm.text import small_batches


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets a temporary one, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="larder-checkpoint-"))
    return sc.getCheckpointDir()


class Scratch:
    """Tables written during one operator call.

    keep() writes a DataFrame and returns it as read back, so a lost executor
    costs a reread and not a recomputation. drop() deletes tables that later
    steps no longer need. What a lazy result still reads stays until the folder
    is emptied, as with checkpoint().
    """

    def __init__(self, spark: SparkSession):
        small_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/larder-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.tables: list[DataFrame] = []
        self.n = 0

    def keep(self, df: DataFrame, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path, partitionBy=partition_by, compression=compression)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        self.tables.append(kept)
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables and let Spark clear the shuffle files of finished steps."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            self.tables = [x for x in self.tables if x is not t]
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(t)))
            path.getFileSystem(conf).delete(path, True)
        jvm.System.gc()

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all but the tables that a lazy result reads."""
        self.drop(*[t for t in self.tables if not any(t is x for x in tables)])
