"""The product page parser on golden pages, broken ones among them."""

import html as h
import re

import pytest
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.pages import Page, fields, product_pages
from larder.plans import pages

URL = "https://shop.example.com/a/b?c=1"

GOLDEN = [
    # the first selector that has an element counts, even if a later one stands earlier in the page
    ('<div class="product-title">late</div><h1> A <b> B </b>\n C</h1>', ("AB" + "C", "", "", {}, [])),
    # an empty element of the first selector still ends the ladder
    ('<h1></h1><div class="product-title">x</div>', ("", "", "", {}, [])),
    ('<p class="prices">no</p><p class="a current-price b">2,49 &euro;</p><p class="price-current">3</p>', ("", "2,49 €", "", {}, [])),
    ('<i data-testid="product-name">n</i><i class="product-name">m</i><i data-testid=price>1</i>', ("n", "1", "", {}, [])),
    # nutrition: the parent of the last text with the word and more than ten characters, in any case
    ("<div>ENERGY: 100 kcal a 100 g</div><div>energy</div><div>Fat <b>fat 3 g of all</b></div>", ("", "", "", {"energy": "ENERGY: 100 kcal a 100 g", "fat": "fat 3 g of all"}, [])),
    ("<div>Fat: <b>3 g of all</b> of it</div>", ("", "", "", {"fat": "Fat:3 g of allof it"}, [])),
    # ingredients: the ladder, then the first word's first long text
    ('<p>Zutaten: Wasser, Zucker und Salz</p><ul class="ingredient-list"><li>Wasser<li>Salz</ul>', ("", "", "WasserSalz", {}, [])),
    ("<p>Zutaten:</p><p>Inhaltsstoffe: Wasser und viel Salz</p><p>ingredients: water and much salt</p>", ("", "", "ingredients: water and much salt", {}, [])),
    # scripts and comments are found by their words; a comment is in no text, a script in its own
    ("<div><!-- protein inside --> visible words here</div><script>var protein_of_all = 1</script>", ("", "", "", {"protein": "var protein_of_all = 1"}, [])),
    ("<div><!-- carbs --> visible words here<style>p {}</style></div>", ("", "", "", {"carbs": "visible words here"}, [])),
    # images
    ('<img src="//x.net/Product.png"><img src="/item/1.jpg"><img data-src="product.gif"><img src="logo.png"><IMG SRC="" data-src="http://y/ITEM.png"/>',
     ("", "", "", {}, ["https://x.net/Product.png", "https://shop.example.com/item/1.jpg", "product.gif", "http://y/ITEM.png"])),
    # broken markup: end tags that close nothing, elements that never end, void elements, text outside
    ("</div><h1>a<p>b</h1>c<p>protein and fat", ("ab", "", "", {"protein": "protein and fat", "fat": "protein and fat"}, [])),
    ("energy of <br>loose texts<hr>", ("", "", "", {"energy": "energy ofloose texts"}, [])),
    ("", ("", "", "", {}, [])),
    ("<h1>1 < 2 &amp; 3", ("1 < 2 & 3", "", "", {}, [])),
]


@pytest.mark.parametrize(("page", "want"), GOLDEN)
def test_golden(page, want):
    title, price, ingredients, nutrition, images = fields(URL, page)
    assert (title, price, ingredients, dict(nutrition), images) == want


def test_rows_with_nulls_copies_and_clashing_names(spark):
    rows = [(1, URL, "<h1>a</h1>"), (1, URL, "<h1>a</h1>"), (2, None, None), (3, None, "<img src='/product'>")]
    df = spark.createDataFrame(rows, "k int, url string, html string").withColumns({c: F.lit(1) for c in ("title", "images", "tag")})
    got = sorted((r["k"], r["title"], r["images"], r["tag"]) for r in product_pages(df).collect())
    assert got == [(1, "a", [], 1), (1, "a", [], 1), (2, "", [], 1), (3, "", ["/product"], 1)]
    assert product_pages(df.where("false")).collect() == []


def test_work_is_linear_in_deep_and_long_pages():
    deep = "<div>fat " * 30_000 + "zutaten"
    long = "<p>zutaten</p>" * 60_000 + "<p>fat</p>" * 60_000
    for page in (deep, long):
        title, *_ = fields(URL, page)
        assert title == ""


def test_page_fields_query(spark, small):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in pages.page_fields(spark, small).collect():
        heads = re.findall(r"(?is)<h1[^>]*>(.*?)</h1>", rows[r["page_id"]])
        assert r["title"] == ("".join(h.unescape(x).strip() for x in re.split(r"<[^>]*>", heads[0])) if heads else "")
        shown = "".join(t for t, _, seen in Page(rows[r["page_id"]]).texts if seen).lower()
        assert r["facts"] <= sum(w in rows[r["page_id"]].lower() for w in fixed.PAGE_NUTRITION) and (r["facts"] or not any(w in shown for w in ("nutrition", "protein")))


def test_pages_of_one_small_file_are_parsed_in_many_tasks(spark, tmp_path):
    parts = spark.range(4000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type", "cast(id % 50 AS int) AS p_size", "1.0D AS p_retailprice")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = pages.product_page(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    each = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(each) == 4000 and len(each) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(each) < 1.2 * min(each)
