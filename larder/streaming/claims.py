"""Claims of work items as a stream with timers, and a table of a stream's progress."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

CLAIMS_OUT = "file_id string, worker string, at timestamp, what string"


class _Claims(StatefulProcessor):
    """State of an item: who has claimed it, and until when the claim holds."""

    def __init__(self, stall: timedelta, by_event: bool):
        self.stall, self.by_event = int(stall.total_seconds() * 1000), by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        held = [T.StructField("worker", T.StringType()), T.StructField("at", T.LongType()), T.StructField("due", T.LongType())]
        self.claim = handle.getValueState("claim", T.StructType(held))

    def _release(self) -> tuple | None:
        if not self.claim.exists():
            return None
        worker, at, due = self.claim.get()
        self.handle.deleteTimer(due)
        self.claim.clear()
        return worker, at, due

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for frame in rows:
            for at, status, worker in frame.sort_values(["at", "status", "worker"], ascending=[True, False, True])[["at", "status", "worker"]].itertuples(index=False):
                ms = int(pd.Timestamp(at).value // 10**6)
                held = self.claim.get() if self.claim.exists() else None
                if held and self.by_event and ms >= held[2]:  # the watermark has not come here yet, but this event has
                    self._release()
                    out.append((key[0], held[0], pd.Timestamp(held[2], unit="ms"), "stalled"))
                    held = None
                if status == "processing":
                    if held and held[0] != worker:
                        out.append((key[0], worker, at, "refused"))
                        continue
                    self._release()
                    due = (ms if self.by_event else timerValues.getCurrentProcessingTimeInMs()) + self.stall
                    self.claim.update((worker, ms, due))
                    self.handle.registerTimer(due)
                    if not held:
                        out.append((key[0], worker, at, "claimed"))
                elif status in ("completed", "failed") and held and held[0] == worker:
                    self._release()
                    out.append((key[0], worker, at, status))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        if self.claim.exists() and self.claim.get()[2] == due:
            out.append((key[0], self.claim.get()[0], pd.Timestamp(due, unit="ms"), "stalled"))
            self.claim.clear()
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["file_id", "worker", "at", "what"]).astype({"file_id": "object", "worker": "object", "at": "datetime64[ns]", "what": "object"})


def claims(events: DataFrame, stall: timedelta = timedelta(minutes=30), late: timedelta | None = timedelta(minutes=5)) -> DataFrame:
    """Of (file_id, worker, status, at): what became of each item, as (file_id, worker, at, what).

    what: claimed; refused, while another worker holds the item; completed or
    failed, as its holder says; stalled, when a claim was not renewed (by a further
    `processing` of its worker) for `stall`. A claim ends by a timer, with no event
    of its own: when the watermark, `late` behind the newest event of any item, has
    passed its end, or, where `late` is None, when the clock has. Of events at one
    time a claim comes before an end. State is a row a
    claimed item; other items have none. Needs a state store with timers, RocksDB.
    """
    by_event = late is not None
    if by_event:
        events = events.withWatermark("at", f"{int(late.total_seconds())} seconds")
    return events.groupBy("file_id").transformWithStateInPandas(_Claims(stall, by_event), CLAIMS_OUT, "append", "EventTime" if by_event else "ProcessingTime")


class ProgressTable(StreamingQueryListener):
    """Keeps a row for each batch of the session's streams, as JSON under `path`.

    A file for each batch and run, so a repeated batch replaces its row. Written
    through the file system alone: no job runs while a stream reports.
    """

    SCHEMA = (
        "name string, query string, run string, batch long, at string, rows long, rows_per_second double, took_ms long, state_rows long, ended string"
    )

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _put(self, name: str, row: dict) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{row['run']}/{name}.json")
        out = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._put(
            str(p.batchId),
            {
                "name": p.name, "query": str(p.id), "run": str(p.runId), "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows,
                "rows_per_second": p.processedRowsPerSecond, "took_ms": p.batchDuration, "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            },
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._put("ended", {"query": str(event.id), "run": str(event.runId), "ended": event.exception or "done"})


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ProgressTable: one a batch, and one with `ended` for each run that is over."""
    return spark.read.schema(ProgressTable.SCHEMA).option("recursiveFileLookup", True).json(path)
