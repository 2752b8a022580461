"""Scans of a relational store: an embedded one in memory, which Spark brings along."""

import uuid

import pytest

from larder.sources import relational


@pytest.fixture(scope="module")
def store(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rows = [(k, f"name {k % 7}", None if k % 10 == 0 else k * 0.5, f"2024-01-{k % 28 + 1:02d}") for k in range(1000)]
    df = spark.createDataFrame(rows, "id long, name string, price double, day string").selectExpr("id", "name", "price", "cast(day AS date) AS day")
    # the store compares VARCHAR, but not the CLOB that Spark makes of strings
    relational.write(df, url, "products", "overwrite", {"createTableColumnTypes": "name VARCHAR(40)"})
    return url, rows


def parts(df):
    return df.rdd.getNumPartitions()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_rows_in_parts(spark, store):
    url, rows = store
    df = relational.scan(spark, url, "products", "id", rows=300)
    assert parts(df) == 4 and sorted(r["id"] for r in df.collect()) == [r[0] for r in rows]
    assert parts(relational.scan(spark, url, "products", "id", rows=10, most=5)) == 5
    assert parts(relational.scan(spark, url, "products", "day", rows=200)) == 5
    assert parts(relational.scan(spark, url, "products")) == 1


def test_filters_and_columns_are_left_to_the_store(spark, store):
    url, rows = store
    df = relational.scan(spark, url, "products", "id", rows=300).where("price > 400 AND name = 'name 3'").select("id")
    text = plan(df)
    assert "PushedFilters: [*IsNotNull(price), *IsNotNull(name), *GreaterThan(price,400.0), *EqualTo(name,name 3)]" in text
    assert "ReadSchema: struct<id:bigint>" in text and "Filter" not in text.replace("PushedFilters", "")
    assert sorted(r[0] for r in df.collect()) == [k for k, n, p, _ in rows if n == "name 3" and (p or 0) > 400]


def test_bounds_and_keys(spark, store):
    url, _ = store
    with pytest.raises(ValueError, match="ranges"):
        relational.scan(spark, url, "products", "name")
    one = spark.createDataFrame([(5, "a")], "id long, name string")
    relational.write(one, url, "single", "overwrite")
    assert parts(relational.scan(spark, url, "single", "id", rows=1)) == 1
    relational.write(one.where("false"), url, "nothing", "overwrite")
    assert relational.scan(spark, url, "nothing", "id").collect() == []
    relational.write(spark.createDataFrame([(None, "x"), (1, "y"), (9, "z")], "id long, name string"), url, "gaps", "overwrite")
    got = relational.scan(spark, url, "gaps", "id", rows=1)
    assert parts(got) > 1 and sorted(r["name"] for r in got.collect()) == ["x", "y", "z"]


def test_appends_and_changes(spark, store):
    url, _ = store
    relational.write(spark.createDataFrame([(1, "a")], "id long, name string"), url, "log", "overwrite")
    relational.write(spark.createDataFrame([(2, "b")], "id long, name string"), url, "log")
    assert sorted(map(tuple, relational.scan(spark, url, "log").collect())) == [(1, "a"), (2, "b")]
