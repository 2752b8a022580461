"""Golden cases of the column functions, among them umlauts, blanks and nulls."""

import pytest
from pyspark.sql import functions as F

from larder.functions import text as t

CASES = [
    (lambda: t.price(F.lit("3,19 €")), 3.19),
    (lambda: t.price(F.lit("kostenlos")), None),
    (lambda: t.price(F.lit(None).cast("string")), None),
    (lambda: t.price_or_zero(F.lit("")), 0.0),
    (lambda: t.price_amount(F.lit("ab 12,5 € je kg")), 12.5),
    (lambda: t.eur(F.lit("3")), "3,00 €"),
    (lambda: t.eur(F.lit("3.5 EUR")), "3,5 €"),
    (lambda: t.base_price(F.lit("2,99 / 1 kg")), "2,99 €"),
    (lambda: t.weight_norm(F.lit("3 Stk")), "3pcs"),
    (lambda: t.weight_norm(F.lit("iKg")), "1kg"),
    (lambda: t.largest_weight(F.lit("2 kg, 500 g, 500 ml")), "500 g"),
    (lambda: t.largest_weight(F.lit("ohne")), ""),
    (lambda: t.name_builder(F.lit(" Bio Bananen ")), "banana"),
    (lambda: t.name_builder(F.lit("Rote Bete")), "rote_bete"),
    (lambda: t.name_dedup(F.lit("Süße Äpfel!  (lose)")), "süße apple lose"),
    (lambda: t.brand(F.lit(" dr oetker ")), "Dr. Oetker"),
    (lambda: t.unit(F.lit("Gramm")), None),
    (lambda: t.unit(F.lit("ML")), "l"),
    (lambda: t.category(F.lit("Käse aus Holland")), "Milch & Butter"),
    (lambda: t.nutrient(F.lit("1200 kcal per 100g, brennwert: 340 kcal"), "calories"), 340.0),
    (lambda: t.similarity(F.lit("Müsli"), F.lit("Musli")), 0.8),
    (lambda: t.similarity(F.lit(""), F.lit("")), 1.0),
    (lambda: t.word_jaccard(F.lit("rote bete"), F.lit("weiße bohnen")), 50),
    (lambda: t.file_name(F.lit("!!!")), "unnamed"),
    (lambda: t.drop_preamble(F.lit("PRODUCT NAME: Angebot Käse")), "Käse"),
    (lambda: t.json_slice(F.lit('so {"a": {"b": 1}} ja')), '{"a": {"b": 1}}'),
    (lambda: t.falsy(F.lit(""), F.lit(None).cast("string"), F.lit("x")), "x"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_golden(k, spark):
    column, want = CASES[k]
    got = spark.range(1).select(column().alias("x")).first()["x"]
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_md5_signature(spark):
    import hashlib

    got = spark.range(1).select(t.signature_simple(F.lit("Rewe"), F.lit(" Brot "), F.lit("500G")).alias("x")).first()["x"]
    assert got == hashlib.md5(b"rewe_brot_500g").hexdigest()[:16]
