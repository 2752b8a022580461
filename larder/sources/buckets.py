"""A keyed table in hash buckets, changed batch by batch.

    table/data/batch=7/bucket=3/part-...    the rows of bucket 3 as batch 7 left them
    table/commits/7                         JSON lines: which batch each bucket is at

A batch reads and writes only the buckets that its keys are in. Its commit is
written last, so readers see a batch whole or not at all, and one that is done
again starts from the commit before it and leaves the same rows. The table as it
was before the last batch stays for readers that have begun; older buckets go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.files import exists
from larder.sources.sinks import latest


def _store(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    store, target = _store(spark, path)
    store.delete(target, True)


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    if not exists(spark, folder):
        return []
    store, target = _store(spark, folder)
    names = [x.getPath().getName() for x in store.listStatus(target)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


def _commits(spark: SparkSession, table: str) -> list[int]:
    return [n for n in _numbers(spark, f"{table}/commits") if exists(spark, f"{table}/commits/{n}/_SUCCESS")]


def _state(spark: SparkSession, table: str, number: int) -> dict[int, int]:
    """Which batch each bucket is at; as many entries as buckets at most."""
    return {r["bucket"]: r["batch"] for r in spark.read.schema("bucket int, batch long").json(f"{table}/commits/{number}").collect()}


def _rows(spark: SparkSession, table: str, schema: T.StructType, at: dict[int, int]) -> DataFrame:
    paths = [f"{table}/data/batch={b}/bucket={k}" for k, b in at.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def current(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table after its last committed batch."""
    done = _commits(spark, table)
    return _rows(spark, table, schema, _state(spark, table, done[-1]) if done else {})


def upsert_batch(table: str, batch: DataFrame, number: int, key: Sequence[str], order: str, schema: T.StructType, buckets: int = 64) -> None:
    """Keep the last write of each key (by `order`) among the table's rows and a batch's.

    number: the batch's place, from 0 on. A number that was committed is done again
    from the state before it, so repeating a batch changes nothing.
    """
    if "bucket" in schema.names:
        raise ValueError("bucket is the name of the table's folders")
    spark = batch.sparkSession
    before = max((n for n in _commits(spark, table) if n < number), default=None)
    state = _state(spark, table, before) if before is not None else {}
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    rows = batch.select(*schema.names)
    touched = sorted(r[0] for r in rows.select(bucket).distinct().collect())
    if touched:
        old = _rows(spark, table, schema, {k: state[k] for k in touched if k in state})
        new = latest(old.unionByName(rows), list(key), order).withColumn("bucket", bucket)
        new.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/batch={number}")
    after = state | dict.fromkeys(touched, number)
    commit = spark.createDataFrame(sorted(after.items()), "bucket int, batch long").coalesce(1)
    commit.write.mode("overwrite").json(f"{table}/commits/{number}")
    _clean(spark, table, before, number, state, after)


def _clean(spark: SparkSession, table: str, before: int | None, number: int, *kept: dict[int, int]) -> None:
    """Delete what neither the last commit nor the one before it refers to."""
    used = {(b, k) for state in kept for k, b in state.items()}
    for n in _commits(spark, table):
        if n not in (before, number):
            _delete(spark, f"{table}/commits/{n}")
    for b in _numbers(spark, f"{table}/data", "batch="):
        there = _numbers(spark, f"{table}/data/batch={b}", "bucket=")
        gone = [k for k in there if (b, k) not in used]
        if len(gone) == len(there):
            _delete(spark, f"{table}/data/batch={b}")
        else:
            for k in gone:
                _delete(spark, f"{table}/data/batch={b}/bucket={k}")
