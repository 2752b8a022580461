"""The registry of providers."""

import pytest
from pyspark.sql import functions as F

from larder.operators.providers import Provider, Providers


def made():
    return Providers([Provider("a", F.upper, 0, 8, 7), Provider("b", F.reverse, 20, 5, 9), Provider("c", F.lower, 10, 6, 9)])


def test_names_and_refusals():
    p = made()
    assert p.names() == ["a", "b", "c"] and p.get("b").cents == 20
    with pytest.raises(ValueError, match="unknown provider x"):
        p.get("x")
    with pytest.raises(ValueError, match="already"):
        p.register(Provider("a", F.lower, 0, 1, 1))
    for wrong in ((0, 11, 1), (0, 1, -1), (-1, 1, 1)):
        with pytest.raises(ValueError, match="ratings"):
            p.register(Provider("d", F.lower, *wrong))


def test_best_and_run(spark):
    rows = [(1, 100, ["a", "b", "c"]), (2, 100, ["a", "b"]), (3, 5, ["a", "b", "c"]), (4, 5, ["b"]), (5, 10, []), (6, None, ["a"]), (7, 0, ["a", "x"])]
    df = spark.createDataFrame([(*r, "xY") for r in rows], "k int, budget int, up array<string>, v string")
    p = made()
    got = p.run(df.withColumn("p", p.best(F.col("budget"), F.col("up"))), "p", "v", "out", "cost").orderBy("k").collect()
    assert [(r["p"], r["out"], r["cost"]) for r in got] == [("c", "xy", 10), ("b", "Yx", 20), ("a", "XY", 0), (None, None, None), (None, None, None), (None, None, None), ("a", "XY", 0)]
    assert [r[0] for r in df.orderBy("k").select(p.best(F.col("budget"))).collect()] == ["c", "c", "a", "a", "c", None, "a"]
