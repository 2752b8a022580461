"""Sources asked in turn."""

from larder.operators.ladder import first_hits, lookup


def test_later_sources_see_only_what_is_left(spark):
    items = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, None, "y"), (4, None, "y")], "k int, one string, two string")
    source = spark.createDataFrame([("a", 5), ("a", 3), ("a", 9), ("x", 1), ("y", 2), (None, 7)], "phrase string, id int")
    ask, seen = lookup(source, "phrase", "id", 2), []

    def rung(term):
        def run(left):
            seen.append(sorted(r["k"] for r in left.collect()))
            return ask(term)(left)

        return run

    got = first_hits(items, "k", [rung("one"), rung("two"), rung("one")])
    assert sorted((r["k"], r["rung"], r["id"], r["hit"]) for r in got.collect()) == [(1, 0, 3, 1), (1, 0, 5, 2), (2, 1, 2, 1), (4, 1, 2, 1), (4, 1, 2, 1)]
    assert seen == [[1, 2, 3, 4, 4], [2, 3, 4, 4], [3]]


def test_no_source_is_asked_for_nothing(spark):
    items = spark.createDataFrame([(1, "a")], "k int, one string")
    ask = lookup(spark.createDataFrame([("a", 5)], "phrase string, id int"), "phrase", "id", 2)

    def never(_):
        raise AssertionError("nothing is left to ask for")

    assert first_hits(items, "k", [ask("one"), never]).count() == 1
    assert first_hits(items.where("false"), "k", [ask("one"), never]).count() == 0
