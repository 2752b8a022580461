"""Claims that expire between events, and a stream's progress table."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest

from larder.streaming import claims as c

START = datetime(2024, 1, 1)


@pytest.fixture
def timers(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(name, before)


def put(folder, number, rows):
    text = "\n".join(json.dumps({"file_id": f, "worker": w, "status": s, "at": (START + timedelta(minutes=m)).isoformat()}) for f, w, s, m in rows)
    (folder / f"{number}.json").write_text(text)
    os.utime(folder / f"{number}.json", (1_700_000_000 + number,) * 2)  # files are read in the order of their times


def run(spark, folder, tmp_path, name, **how):
    events = spark.readStream.schema("file_id string, worker string, status string, at timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    sink = c.claims(events, **how).writeStream.format("parquet").option("path", str(tmp_path / f"out-{name}")).option("checkpointLocation", str(tmp_path / f"cp-{name}")).queryName(name)
    return sink.outputMode("append")


def found(spark, tmp_path, name):
    rows = spark.read.schema(c.CLAIMS_OUT).parquet(str(tmp_path / f"out-{name}")).collect()
    return sorted((r["file_id"], int((r["at"] - START).total_seconds() // 60), r["worker"], r["what"]) for r in rows)


def test_claims_by_event_time(timers, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, 0, [("a", "w1", "processing", 0), ("b", "w1", "processing", 1), ("b", "w2", "processing", 2), ("d", "w9", "completed", 2)])
    put(folder, 1, [("b", "w1", "completed", 10), ("c", "w3", "processing", 12), ("c", "w3", "processing", 30)])
    put(folder, 2, [("e", "w4", "processing", 41)])  # no event of a, but time passes 30 and the lateness
    put(folder, 3, [("a", "w2", "processing", 45), ("c", "w5", "failed", 46)])
    put(folder, 4, [("e", "w4", "failed", 50), ("c", "w5", "processing", 61)])  # after the claim's end, before the watermark says so
    put(folder, 5, [("z", "w1", "processing", 500)])
    listener = c.ProgressTable(timers, str(tmp_path / "progress"))
    timers.streams.addListener(listener)
    try:
        run(timers, folder, tmp_path, "claims").trigger(availableNow=True).start().awaitTermination()
        time.sleep(1)
    finally:
        timers.streams.removeListener(listener)
    assert found(timers, tmp_path, "claims") == [
        ("a", 0, "w1", "claimed"), ("a", 30, "w1", "stalled"), ("a", 45, "w2", "claimed"), ("a", 75, "w2", "stalled"),
        ("b", 1, "w1", "claimed"), ("b", 2, "w2", "refused"), ("b", 10, "w1", "completed"),
        ("c", 12, "w3", "claimed"), ("c", 60, "w3", "stalled"), ("c", 61, "w5", "claimed"), ("c", 91, "w5", "stalled"),
        ("e", 41, "w4", "claimed"), ("e", 50, "w4", "failed"), ("z", 500, "w1", "claimed"),
    ]
    rows = c.progress(timers, str(tmp_path / "progress")).collect()
    batches = {r["batch"]: r["rows"] for r in rows if r["batch"] is not None}
    assert [batches[k] for k in range(6)] == [4, 3, 1, 2, 2, 1] and {r["name"] for r in rows if r["batch"] is not None} == {"claims"}
    assert [r["ended"] for r in rows if r["ended"]] == ["done"]


def test_claims_by_the_clock_need_no_event(timers, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, 0, [("a", "w1", "processing", 0), ("b", "w1", "processing", 1), ("b", "w1", "completed", 1)])
    query = run(timers, folder, tmp_path, "clock", stall=timedelta(seconds=2), late=None).trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(60):
            time.sleep(1)
            got = [(x[0], x[3]) for x in found(timers, tmp_path, "clock")]
            if ("a", "stalled") in got:
                break
    finally:
        query.stop()
    assert sorted(got) == [("a", "claimed"), ("a", "stalled"), ("b", "claimed"), ("b", "completed")]
