"""Scans of a relational store by Spark's JDBC reader."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column types whose range can be cut into parts.
RANGED = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "decimal")


def scan(spark: SparkSession, url: str, table: str, key: str | None = None, rows: int = 1_000_000, most: int = 1000, options: Mapping[str, str] | None = None) -> DataFrame:
    """A table of the store, in parts of about `rows` rows by ranges of `key`, at most `most` of them.

    Filters, column choice, limits and simple aggregates on the result are done by
    the store. Without a key one task reads the table. The store is asked for the
    key's bounds and the number of rows first; rows without a key are in the first
    part. Every row is in one part, also rows that come in between.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    whole = reader.load()
    if key is None:
        return whole
    kind = dict(whole.dtypes)[key]
    if not kind.startswith(RANGED):
        raise ValueError(f"{key} is {kind}, which has no ranges to cut")
    low, high, n = whole.agg(F.min(key), F.max(key), F.count("*")).first()
    parts = min(most, -(-n // rows)) if n else 1
    if parts < 2 or low == high:
        return whole
    return reader.option("partitionColumn", key).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts).load()


def write(df: DataFrame, url: str, table: str, mode: str = "append", options: Mapping[str, str] | None = None) -> None:
    """Rows into a table of the store, one connection a partition."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).mode(mode).save()
