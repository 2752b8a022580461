"""Needles in texts against plain Python."""

import random

import pytest

from larder.operators.matching import containing


def plain(needles, texts, most):
    out = set()
    for key, needle in needles:
        if key is not None and needle is not None:
            ids = sorted({i for k, t, i in texts if k == key and t is not None and needle in t and i is not None})
            out |= {(key, needle, i) for i in ids[:most]}
    return out


@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_containing_as_plain(spark, shard):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abß日 ") for _ in range(n))
    texts = [(r.choice(["x", "y", None]), r.choice([None, "", word(3), word(12), word(30)]), r.randrange(200)) for _ in range(400)]
    needles = [(r.choice(["x", "y", "z", None]), word(r.choice([0, 1, 1, 2, 3, 5]))) for _ in range(150)] + [("x", None), ("x", ""), ("y", "a"), ("y", "ab"), ("y", "b")]
    got = containing(spark.createDataFrame(needles, "key string, needle string"), spark.createDataFrame(texts, "key string, text string, old_id long"), 5, shard)
    assert {tuple(x) for x in got.collect()} == plain(needles, texts, 5)


def test_a_needle_in_all_texts_makes_few_rows(spark):
    """The needle `a` is in every text, yet no step has a row for each text it is in."""
    texts = spark.range(50_000).selectExpr("'k' AS key", "concat('a', id) AS text", "id AS old_id").repartition(6)
    got = containing(spark.createDataFrame([("k", "a"), ("k", "a49"), ("k", "zz")], "key string, needle string"), texts, 3)
    assert sorted(map(tuple, got.collect())) == [("k", "a", 0), ("k", "a", 1), ("k", "a", 2), ("k", "a49", 49), ("k", "a49", 490), ("k", "a49", 491)]
    step = got._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in step and "contains" not in step.lower()


def test_no_needles_or_texts(spark):
    n, t = spark.createDataFrame([], "key string, needle string"), spark.createDataFrame([], "key string, text string, old_id long")
    assert containing(n, t, 5).collect() == []
    assert containing(spark.createDataFrame([("k", "a"), ("k", "")], n.schema), t, 5).collect() == []
