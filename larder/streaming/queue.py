"""Draining a folder of work, and a circuit breaker per model, as streams."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from larder.sources.buckets import upsert_batch


def drain(
    spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str, key: list[str], order: str, files: int = 100, buckets: int = 64
):
    """Take in all files that wait, and keep the last write of each key (by `order`) in a bucketed table.

    The checkpoint replaces the queue's claims: a file is in one micro-batch, and a
    failed batch is done again, which leaves the same table. A batch reads and
    writes only the buckets of its keys; buckets.current() reads the table.
    """

    def take(batch: DataFrame, number: int) -> None:
        upsert_batch(table, batch, number, key, order, schema, buckets)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(source)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


BREAKER_OUT = "model string, at timestamp, ok boolean, failures int, open boolean"


def circuit_breaker(attempts: DataFrame, most: int = 3, reset: timedelta = timedelta(seconds=300)) -> DataFrame:
    """(model, at, ok) -> with the failures in a row before each attempt, and whether the model was shut out then.

    Shut out after `most` failures, until `reset` after the last of them.
    State is one row a model.
    """

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, last = state.get if state.exists else (0, 0)
        for frame in frames:
            out = []
            for at, ok in frame.sort_values("at")[["at", "ok"]].itertuples(index=False):
                micros = int(pd.Timestamp(at).value // 1000)
                out.append((key[0], at, bool(ok), failures, failures >= most and micros - last < reset.total_seconds() * 1e6))
                failures, last = (0, last) if ok else (failures + 1, micros)
            yield pd.DataFrame(out, columns=["model", "at", "ok", "failures", "open"]).astype({"failures": "int32"})
        state.update((failures, last))

    return attempts.groupBy("model").applyInPandasWithState(step, BREAKER_OUT, "failures int, last long", "append", GroupStateTimeout.NoTimeout)


def by_priority(batch: DataFrame) -> DataFrame:
    """Open work of a micro-batch, the highest priority and then the oldest first."""
    return batch.where(F.col("status").isin("pending", "processing")).orderBy(F.col("priority").desc(), "created_at")
