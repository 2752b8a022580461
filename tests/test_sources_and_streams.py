"""Files, sinks, greedy grouping and streams."""

import json
from datetime import datetime, timedelta
from difflib import SequenceMatcher

import pytest
from pyspark.sql import types as T

from larder.operators.grouping import fuzzy_groups, keep_first_boxes
from larder.plans import enrichment
from larder.plans.views import grocery
from larder.sources import buckets, files, sinks
from larder.streaming import queue


def test_csv_notions_of_missing(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('name,n,note\nNA,1,x\n"a ""q"" b",x,\nnull,3.5,"two\nlines"\n', encoding="utf-8")
    typed = files.csv_default_na(spark, str(p), T.StructType.fromDDL("name string, n double, note string"))
    assert [tuple(r) for r in typed.collect()] == [(None, 1.0, "x"), ('a "q" b', None, None), (None, 3.5, "two\nlines")]
    assert [r["name"] for r in files.csv_empty_na(spark, str(p)).collect()] == ["NA", 'a "q" b', "null"]
    assert [r["note"] for r in files.csv_texts(spark, str(p)).collect()] == ["x", "", "two\nlines"]


def test_csv_absent_and_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    assert files.csv_if_there(spark, str(tmp_path / "no.csv"), ["x"]).collect() == []
    got = files.csv_union(spark, [str(tmp_path / n) for n in ("a.csv", "no.csv", "b.csv")])
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("-", "3", "4"), ("1", "2", "-")]
    with pytest.raises(FileNotFoundError):
        files.csv_union(spark, [str(tmp_path / "no.csv")])


def test_json_and_images(spark, tmp_path):
    schema = T.StructType.fromDDL("category string, subs array<string>")
    (tmp_path / "c.json").write_text('{\n "category": "Obst",\n "subs": ["Beeren"]\n}')
    assert files.json_document(spark, str(tmp_path / "c.json"), schema).first()["subs"] == ["Beeren"]
    assert files.json_document(spark, str(tmp_path / "no.json"), schema).first()["category"] is None
    (tmp_path / "i.PNG").write_bytes(b"x")
    (tmp_path / "i.txt").write_bytes(b"y")
    assert [r["md5"] for r in files.image_files(spark, str(tmp_path)).collect()] == ["9dd4e461268c8034f5c8564e155c67a6"]


def test_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "ü\nv", "x")], "id int, name string, brand string")
    sinks.write_csv(df, str(tmp_path / "out"), ["name", "brand", "extra"])
    back = files.csv_empty_na(spark, str(tmp_path / "out"), ["name", "brand", "extra"])
    assert sorted(map(str, back.collect())) == sorted(["Row(name='a \"b\", c', brand=None, extra=None)", "Row(name='ü\\nv', brand='x', extra=None)"])
    assert sinks.ordered(df, ["brand", "no"]).columns == ["brand", "id", "name"]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ts int")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "k int, v string, ts int")
    assert sorted(tuple(r) for r in sinks.upsert(old, sinks.latest(new, ["k"], "ts"), ["k"]).collect()) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]
    assert [tuple(r) for r in sinks.insert_or_ignore(old, new, ["k"], "ts").collect()] == [(3, "e", 1)]
    changed = sinks.update_columns(old, new.where("ts = 2").select("k", "v"), ["k"])
    assert sorted(tuple(r) for r in changed.collect()) == [(1, "a", 1), (2, "c", 1)]


def test_keep_first_boxes(spark):
    rows = [(1, 1, 0, 0, 10, 10), (1, 2, 1, 0, 10, 10), (1, 3, 20, 0, 10, 10), (1, 4, 2, 0, 10, 10), (2, 1, 0, 0, 5, 5)]
    df = spark.createDataFrame(rows, "screen int, ord int, x int, y int, w int, h int")
    assert sorted((r["screen"], r["ord"]) for r in keep_first_boxes(df).collect()) == [(1, 1), (1, 3), (2, 1)]
    # a small box inside a large one covers little of the union, but all of its own area; half is not more than half
    inside = [(1, 1, 0, 0, 10, 10), (1, 2, 2, 2, 3, 3), (1, 3, 5, 0, 10, 10), (2, 1, 0, 0, 3, 3), (2, 2, 0, 0, 10, 10)]
    df = spark.createDataFrame(inside, "screen int, ord int, x int, y int, w int, h int")
    kept = lambda **how: sorted((r["screen"], r["ord"]) for r in keep_first_boxes(df, **how).collect())
    assert kept() == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    assert kept(of="own") == [(1, 1), (1, 3), (2, 1), (2, 2)]
    with pytest.raises(ValueError):
        keep_first_boxes(df, of="both")


def test_fuzzy_groups(spark):
    rows = [(1, 1, "REWE Bio Milch"), (1, 2, "Rewe Bio Milch!"), (1, 3, "Brot"), (2, 1, "Brot"), (1, 4, None), (1, 5, "rewe bio milch")]
    got = fuzzy_groups(spark.createDataFrame(rows, "k int, ord int, t string"), "k", "t", "ord").collect()
    assert sorted((r["k"], r["ord"], r["group"]) for r in got) == [(1, 1, 0), (1, 2, 0), (1, 3, 1), (1, 4, 2), (1, 5, 0), (2, 1, 0)]


def test_fuzzy_group_query_against_plain_python(spark):
    name, found = "/root/testdata/sf0.001", {}
    for r in sorted(enrichment.fuzzy_group(spark, name).collect(), key=lambda r: (r["brand"] or "", r["place"])):
        found.setdefault(r["brand"], []).append((r["name"], r["group"]))
    p = grocery(spark, name).selectExpr("brand", "concat_ws(' ', product_name, weight) AS name").distinct().collect()
    assert sum(map(len, found.values())) == len(p)
    for brand, got in found.items():
        names = sorted(r["name"] for r in p if r["brand"] == brand)
        heads, groups = [], []
        for low in map(str.lower, names):
            like = [i for i, h in enumerate(heads) if SequenceMatcher(None, low, h).ratio() > 0.9]
            groups.append(like[0] if like else len(heads))
            heads += [] if like else [low]
        assert got == list(zip(names, groups))


def test_drain_keeps_the_last_write(spark, tmp_path):
    schema = T.StructType.fromDDL("file string, status string, ts long")
    src = tmp_path / "in"
    src.mkdir()
    for k, rows in enumerate([[("a", "pending", 1), ("b", "pending", 1)], [("a", "completed", 2), ("a", "processing", 1)]]):
        (src / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(schema.names, r))) for r in rows))
    run = lambda: queue.drain(spark, str(src), schema, str(tmp_path / "t"), str(tmp_path / "cp"), ["file"], "ts", files=1).awaitTermination()
    run()
    (src / "2.json").write_text(json.dumps({"file": "c", "status": "failed", "ts": 1}))
    run()
    got = sorted((r["file"], r["status"]) for r in buckets.current(spark, str(tmp_path / "t"), schema).collect())
    assert got == [("a", "completed"), ("b", "pending"), ("c", "failed")]


def test_circuit_breaker_stream(spark, tmp_path):
    start = datetime(2024, 1, 1)
    src = tmp_path / "in"
    src.mkdir()
    oks = [False, False, False, True, False, False, False]
    for k, ok in enumerate(oks):
        at = start + timedelta(seconds=60 * k if k < 6 else 4000)
        (src / f"{k}.json").write_text(json.dumps({"model": "m", "at": at.isoformat(), "ok": ok}))
    stream = spark.readStream.schema("model string, at timestamp, ok boolean").json(str(src))
    q = queue.circuit_breaker(stream).writeStream.format("memory").queryName("breaker").outputMode("append")
    q.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = [(r["failures"], r["open"]) for r in spark.sql("SELECT * FROM breaker ORDER BY at").collect()]
    assert got == [(0, False), (1, False), (2, False), (3, True), (0, False), (1, False), (2, False)]
