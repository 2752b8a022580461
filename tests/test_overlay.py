"""Overlaid documents against plain recursion."""

import json
import random

import pytest

from larder.operators.overlay import documents, overlaid


def laid(base, update):
    out = dict(base)
    for k, v in update.items():
        out[k] = laid(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def nested(r, depth=0):
    kind = r.random()
    if depth < 4 and (depth == 0 or kind < 0.55):
        return {r.choice(["a", "b", "c", "é.x", ""]): nested(r, depth + 1) for _ in range(r.choice([0, 1, 2, 3]))}
    return r.choice([None, 0, 1.5, "x", "", True, [1, {"a": 2}], [], {}, "日\n"])


@pytest.mark.parametrize("seed", [1, 2])
def test_as_plain_recursion(spark, seed):
    r = random.Random(seed)
    rows, want = [], {}
    for k in [None, *range(150)]:
        for n in range(r.choice([1, 2, 3, 6]) if k else 40):
            d = nested(r)
            rows.append((k, n, json.dumps(d)))
            want[k] = laid(want.get(k, {}), d)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, n int, doc string").repartition(5)
    got = {x["key"]: json.loads(x["document"]) for x in documents(overlaid(df, "k", "n", "doc")).collect()}
    assert got == want


def test_texts_that_are_no_objects(spark):
    rows = [(1, 0, '{"a": {"b": 1}}'), (1, 1, "no json"), (1, 2, None), (1, 3, "[1]"), (1, 4, '{"a": {"c": {}}}'), (1, 4, '{"a": {"c": {}}}'), (2, 0, "5"), (3, 0, "{}")]
    df = spark.createDataFrame(rows, "k int, n int, doc string")
    got = sorted(map(tuple, documents(overlaid(df, "k", "n", "doc")).collect()))
    assert got == [(1, '{"a":{"b":1,"c":{}}}'), (3, "{}")]
    assert sorted(map(tuple, overlaid(df, "k", "n", "doc").collect())) == [(1, ["a", "b"], "1"), (1, ["a", "c"], "{}"), (3, [], "{}")]
    assert documents(overlaid(df.where("false"), "k", "n", "doc")).collect() == []


def test_one_key_of_many_layers(spark):
    df = spark.range(50_000).selectExpr("1 AS k", "id AS n", "to_json(named_struct('last', id, 'm', map(cast(id % 5 AS string), id), 'v', if(id % 1000 = 7, '1', null))) AS doc")
    got = json.loads(documents(overlaid(df, "k", "n", "doc")).first()["document"])
    assert got == {"last": 49_999, "m": {str(k): 49_995 + k for k in range(5)}, "v": "1"}


def test_votes_meet_as_narrow_rows_before_documents_are_made(spark, small):
    """The first shuffle has the votes' columns by product; paths and values come after it, so a task sends a row for a product's path."""
    from larder.operators import overlay
    from larder.plans import layers

    seen = []
    real, overlay.kept = overlay.kept, lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]) or real(df)
    try:
        layers.layered_documents(spark, small)
    finally:
        overlay.kept = real
    (plan,) = seen
    first = plan[plan.rindex("Exchange ") :]
    assert "MapInArrow" in plan and "MapInArrow" not in first and "product_id" in first.splitlines()[0], plan
