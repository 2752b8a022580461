"""Rule banks on golden cases."""

from pyspark.sql import functions as F

from larder.functions import fixed
from larder.plans import rules


def test_category_hits(spark):
    rows = [
        (1, "Samt Erdbeere extra", "Schwartau", "Fruchtaufstrich bio himbeere"),
        (2, "Rotkäse", "ja!", None),
        (3, "Käse", "", "Gouda, käse"),
        (4, "Nuss-Nougat Creme", "NUTELLA", "  "),
    ]
    df = spark.createDataFrame(rows, "product_id int, product_name string, brand string, description string")
    got = {r["product_id"]: [(h["sub"], h["k"], h["tenths"]) for h in r["hits"]] for r in rules.category_hits(df).collect()}
    subs = [s for _, s, _ in fixed.CATEGORY_PATTERNS]
    assert got[1] == [("Fruchtaufstriche", -1, 4), ("Fruchtaufstriche", 0, 9), ("Fruchtaufstriche", 1, 9), ("Fruchtaufstriche", 3, 9), ("Fruchtaufstriche", 5, 9), ("Obst", subs.index("Obst") + 1, 10)]
    assert got[2] == []  # a word's border, not any place
    assert got[3] == [("Käse", subs.index("Käse"), 7)]
    assert got[4] == [("Nuss- & Schokoaufstriche", -1, 4), ("Nuss- & Schokoaufstriche", 7, 5), ("Nuss- & Schokoaufstriche", 9, 5)]


def test_quality_tenths(spark):
    cases = [
        ("price", "3,19 €", 50), ("price", "3", 1), ("price", " ", 0), ("price", None, 0), ("product_name", "Apfel", 15), ("product_name", "Apfel Braeburn", 34),
        ("brand", "REWE Bio", 40), ("brand", "ja", 10), ("weight", "500", 30), ("weight", "500g", 40), ("unit", "Kg", 30), ("unit", "box", 10), ("price_per_kg", "2,99 €/kg", 50),
    ]
    for field, value, want in cases:
        df = spark.createDataFrame([(value,)], "x string")
        assert df.select(rules.quality_tenths(field, F.col("x"))).first()[0] == want, (field, value)


def test_selected_fields_shuffle_a_line_once(spark, small):
    """A screen's answers are dealt as one row for all fields, and not again by field and value."""
    plan = rules.field_selection(spark, small)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert sum("screen" in x for x in dealt) == 1 and not any("field" in x for x in dealt), plan
