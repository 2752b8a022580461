"""Queries that take all rows, on rows that their cut namesakes leave out."""

import datetime

from larder.plans import catalogue

QUERIES = catalogue.queries()


def _lines(spark, folder, rows):
    """rows: order, line, part, supplier, flag, status, discount."""
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_discount double")
    df.selectExpr("*", "1.0D l_quantity", "10.0D l_extendedprice", "date'2024-01-01' l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_all_models_vote(spark, tmp_path):
    d = _lines(spark, tmp_path, [(1, 1, 7, 3, "A", "O", 0.0), (2, 1, 7, 21, "R", "F", 0.05), (3, 1, 7, 24, "R", "F", 0.05)])
    got = {(r["field"], r["said"], r["agree"]) for r in QUERIES["field_consensus"](spark, d).collect()}
    assert got == {("flag", "R", 2), ("line", "F", 2)}


def test_all_screens(spark, tmp_path):
    d = _lines(spark, tmp_path, [(900, 1, 10, 1, "A", "O", 0.0), (900, 2, 2, 1, "A", "O", 0.0), (3, 1, 5, 1, "A", "O", 0.0)])
    got = {(r["screen"], r["n"], r["matches"], r["first"]) for r in QUERIES["component_prefix"](spark, d).collect()}
    assert got == {(900, 1, 1, "component_10"), (900, 2, 1, "component_2")}


def test_all_users(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(1, 3, at, "view", 1.0, "{}"), (2, 20, at, "view", 1.0, "{}"), (3, 20, at + datetime.timedelta(1), "view", 1.0, "{}")]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r["worker"], r["accesses"]) for r in QUERIES["user_products"](spark, str(tmp_path)).collect()}
    assert got == {(3, 1), (20, 2)}


def _parts(spark, folder, rows):
    """rows: part, name, brand, size."""
    df = spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int")
    df.selectExpr("*", "'t' p_type", "10.0D p_retailprice").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_all_products_are_matched(spark, tmp_path):
    d = _parts(spark, tmp_path, [(1, "ab", "x", 1), (2, "a", "x", 1), (3, "a", "x", 1), (40, "c", "x", 1), (41, "a", "y", 1), (42, "c", "x", 1)])
    got = {(r["new_id"], r["old_id"], r["tier"]) for r in QUERIES["dedup_tiered"](spark, d).collect()}
    assert got == {(2, 1, 2), (3, 2, 1), (40, 1, 3), (40, 2, 3), (40, 3, 3), (42, 40, 1)}


def test_all_offers_are_judged(spark, tmp_path):
    _parts(spark, tmp_path, [(5, "a", "x", 1)])
    d = _lines(spark, tmp_path, [(1, 4, 5, 1, "A", "O", 0.0), (2, 1, 5, 7, "A", "O", 0.0), (3, 5, 5, 1, "A", "O", 0.0)])
    got = {(r["offer_id"], r["action"], r["kinds"]) for r in QUERIES["dedup_conflicts"](spark, d).collect()}
    assert got == {(14, "ask", "price"), (21, "update", "weight"), (35, "ask", "price")}
    assert [tuple(r) for r in QUERIES["pending_conflicts"](spark, d).collect()] == [(5, "a", "10,00 €", 2)]


def test_requests_by_status_and_time(spark, tmp_path):
    at = lambda n: datetime.datetime(2024, 1, n)
    rows = [(1, 1, at(2), "click", 1.0, "{}"), (2, 1, at(1), "signup", 1.0, "{}"), (4, 1, at(3), "signup", 1.0, "{}"), (5, 2, at(3), "signup", 1.0, "{}")]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in QUERIES["submit_requests"](spark, str(tmp_path)).select("state", "priority", "requests", "first").collect()}
    assert got == {("queued", 3, 2, 2), ("completed", 2, 1, 4)}


def test_matches_across_brands_and_case(spark, tmp_path):
    rows = [
        (1, "Rote  Bete!", "Alna", 1), (2, "rote bete", "ALNA", 1), (3, "BETE", "Rewe", 1), (4, "Kohl", "rewe", 2), (5, "Mus", "Ewe", 1),
        (6, "Bio Apfel", "x", 1), (7, "Apfel rot", "X", 1), (8, "...", "q", 1), (9, "ot", "q", 1), (10, "Saft", "", 1),
    ]
    got = {(r["new_id"], r["old_id"], r["tier"]) for r in QUERIES["dedup_tiered_wide"](spark, _parts(spark, tmp_path, rows)).collect()}
    first = {(8, k, 2) for k in range(1, 6)}
    assert got == {(2, 1, 1), (3, 1, 2), (3, 2, 2), (4, 3, 3), (5, 3, 3), (5, 4, 3), (7, 6, 1), (9, 1, 2), (9, 2, 2), (9, 7, 2)} | first
