"""Versions that readers see whole, and rewrites of nested documents."""

import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from larder.sources import published

SCHEMA = "id long, name string, brand struct<name: string, votes: array<struct<model: string, ok: boolean>>>"
ROWS = [(1, "a", ("x", [("m", True), ("n", None)])), (2, None, None), (2, None, None), (3, "c", (None, []))]


def state(path):
    return sorted((os.path.join(d, f), os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(path) for f in names)


def read(spark, path):
    return spark.read.schema(SCHEMA).json(published.current_path(spark, path))


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def test_unchanged_rows_leave_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert published.publish(df, path, published.json_lines) and sorted_rows(read(spark, path)) == sorted_rows(df)
    before = state(path)
    assert not published.publish(df.repartition(3).orderBy(F.desc("id")), path, published.json_lines)
    assert not published.rewrite(lambda d: d, path, lambda p: spark.read.schema(SCHEMA).json(p), spark, published.json_lines)
    assert state(path) == before
    # one repeated row less is a change, and so is a null for an empty text
    assert published.publish(df.dropDuplicates(["id"]), path, published.json_lines)
    assert published.publish(df.na.fill("", ["name"]), path, published.json_lines)


def test_a_conditional_rewrite_of_nested_documents(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(spark.createDataFrame(ROWS, SCHEMA), path, published.json_lines)

    def settle(d):
        agreed = F.exists("brand.votes", lambda v: v["ok"])
        name = F.when(agreed, F.upper("brand.name")).otherwise(F.col("brand.name"))
        return d.withColumn("brand", F.when(F.col("brand").isNotNull(), F.col("brand").withField("name", name)))

    rewrite = partial(published.rewrite, settle, path, lambda p: spark.read.schema(SCHEMA).json(p), spark, published.json_lines)
    assert rewrite() and sorted_rows(read(spark, path)) == sorted_rows(spark.createDataFrame([(1, "a", ("X", ROWS[0][2][1])), *ROWS[1:]], SCHEMA))
    assert not rewrite()


def test_a_failing_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame(ROWS, SCHEMA)
    published.publish(old, path, published.json_lines)
    new = old.withColumn("name", F.lit("new"))

    def torn(df, at):
        published.json_lines(df.limit(1), at)
        os.remove(f"{at}/_SUCCESS")
        raise OSError("the store is gone")

    with pytest.raises(OSError, match="gone"):
        published.publish(new, path, torn)
    assert sorted_rows(read(spark, path)) == sorted_rows(old)
    assert published.publish(new, path, published.json_lines) and sorted_rows(read(spark, path)) == sorted_rows(new)


def test_a_reader_that_has_begun_ends_and_older_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    made = lambda n: spark.createDataFrame([(n,)], "n int")
    published.publish(made(0), path)
    reading = spark.read.parquet(published.current_path(spark, path))
    published.publish(made(1), path)
    assert reading.collect()[0]["n"] == 0
    for n in (2, 3, 2):
        published.publish(made(n), path)
    assert spark.read.parquet(published.current_path(spark, path)).collect()[0]["n"] == 2
    assert len(os.listdir(f"{path}/versions")) == 2
    with pytest.raises(FileNotFoundError):
        published.current_path(spark, str(tmp_path / "nothing"))


def test_digests(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert published.digest(a) == published.digest(a.orderBy(F.desc("k")).repartition(2))
    others = [a.union(a), a.limit(1), a.where("false"), a.withColumnRenamed("v", "w"), a.na.fill("null"), a.withColumn("k", F.col("k").cast("long"))]
    assert len({published.digest(x) for x in [a, *others]}) == 7
