"""Incremental upserts into a bucketed table."""

import os

import pytest
from pyspark.sql import types as T

from larder.sources import buckets

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.LongType())])


def rows(spark, table):
    return sorted(tuple(r) for r in buckets.current(spark, table, SCHEMA).collect())


def files(table):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{table}/data") for f in names if f.endswith(".parquet")}


def put(spark, table, number, some, n=8):
    buckets.upsert_batch(table, spark.createDataFrame(some, SCHEMA), number, ["k"], "at", SCHEMA, n)


def test_as_a_plain_dict(spark, tmp_path):
    import random

    r, table, want = random.Random(1), str(tmp_path / "t"), {}
    assert rows(spark, table) == []
    for n in range(5):
        some = [(r.randrange(40), f"{n}.{k}", 10 * n + k) for k in range(r.choice([0, 1, 15]))]
        put(spark, table, n, some)
        want |= {k: (k, v, at) for k, v, at in some}
        assert rows(spark, table) == sorted(want.values())
    # a late write does not undo a newer one
    k, (_, v, at) = next(iter(want.items()))
    put(spark, table, 5, [(k, "late", at - 1)])
    assert rows(spark, table) == sorted(want.values())


def test_a_batch_writes_its_buckets_only(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, 0, [(k, "x", 0) for k in range(2000)], 32)
    before = files(table)
    put(spark, table, 1, [(7, "y", 1)], 32)
    new = files(table).keys() - before.keys()
    assert len(new) == 1 and before.items() <= files(table).items()
    assert sum(map(os.path.getsize, new)) < sum(map(os.path.getsize, before)) / 8


def test_a_repeated_or_torn_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, 0, [(k, "a", 0) for k in range(10)])
    put(spark, table, 1, [(1, "b", 1), (2, "b", 1)])
    want = rows(spark, table)
    put(spark, table, 1, [(1, "b", 1), (2, "b", 1)])
    assert rows(spark, table) == want
    # data without a commit: readers see the table before, and the batch done again replaces it
    put(spark, table, 2, [(3, "c", 2)])
    os.remove(f"{table}/commits/2/_SUCCESS")
    assert rows(spark, table) == want
    put(spark, table, 2, [(3, "c", 2)])
    assert rows(spark, table) == sorted([*(x for x in want if x[0] != 3), (3, "c", 2)])


def test_older_buckets_go_and_a_reader_that_has_begun_ends(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, 0, [(k, "a", 0) for k in range(100)], 2)
    reading = buckets.current(spark, table, SCHEMA)
    put(spark, table, 1, [(k, "b", 1) for k in range(100)], 2)
    assert {r["v"] for r in reading.collect()} == {"a"}
    for n in range(2, 6):
        put(spark, table, n, [(k, str(n), n) for k in range(100)], 2)
    assert len(files(table)) == 4 and sorted(os.listdir(f"{table}/data")) == ["batch=4", "batch=5"]
    assert [n for n in os.listdir(f"{table}/commits") if n.isdigit()].__len__() == 2


def test_a_column_called_bucket_is_refused(spark, tmp_path):
    schema = T.StructType.fromDDL("bucket long, at long")
    with pytest.raises(ValueError, match="bucket"):
        buckets.upsert_batch(str(tmp_path / "t"), spark.createDataFrame([(1, 1)], schema), 0, ["bucket"], "at", schema)
