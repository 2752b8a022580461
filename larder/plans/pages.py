"""Queries over product pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.pages import product_pages
from larder.plans import views as v

#: Layouts of a shop's pages; {name} and the like stand for a product's columns.
LAYOUTS = (
    "<h1 class=\"big\"> {name} <small>{brand}</small></h1><div class=\"tag price\"><b>{price}</b> inkl. MwSt</div><img src=\"//cdn.example.net/product/{id}.jpg\">"
    "<p class=\"ingredients\">Zutaten: {about}</p><p>Nutrition facts: {about}</p>",
    "<div class=\"product-title\">{brand} <i>{name}</i></div><span data-testid=\"price\">{price}</span><p>{about}</p><img data-src=\"/items/{id}.png\"><img src=\"/logo.png\">"
    "<section>Inhaltsstoffe: {about}</section>",
    "<span class=\"x product-name\">zuletzt</span><h2 data-testid=\"product-name\">{name}</h2><em class=\"current-price\">ab {price}</em><div data-testid=\"ingredients\">{about}<br>ohne Gewähr</div>",
    "<p>{name}</p><p class=\"prices\">{price}</p><!-- {about} --><div>Ingredients:</div><img src=\"product-{id}.webp\"><div>protein: 1</div>",
)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a parts file is small for its rows, so one task would read it and parse all pages
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = v.grocery(spark, sf_dir).select("product_id", "product_name", "brand", "price", "description").repartition(n)
    parts = {"name": F.col("product_name"), "brand": F.col("brand"), "price": F.col("price"), "about": F.col("description"), "id": F.col("product_id").cast("string")}

    def filled(layout: str):
        html = F.lit(layout)
        for k, c in parts.items():
            html = F.replace(html, F.lit(f"{{{k}}}"), c)
        return html

    html = F.coalesce(*[F.when(F.col("product_id") % len(LAYOUTS) == k, filled(x)) for k, x in enumerate(LAYOUTS)])
    return g.select("product_id", F.concat(F.lit("https://shop.example.com/p/"), parts["id"]).alias("url"), html.alias("html"))


def product_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a shop's pages, one page a product in one of four layouts."""
    found = product_pages(_pages(spark, sf_dir))
    facts = F.transform(F.array(*[F.lit(w) for w in fixed.PAGE_NUTRITION]), lambda w: F.concat(w, F.lit("="), F.try_element_at("nutrition", w)))
    return found.select(
        "product_id", "title", "price", "ingredients",
        F.array_join(F.filter(facts, lambda x: x.isNotNull()), "; ").alias("nutrition"), F.array_join("images", " ").alias("images"),
    )


def _product_page_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    html = "CASE product_id % 4 " + " ".join(f"WHEN {k} THEN {q(x)}" for k, x in enumerate(LAYOUTS)) + " END"
    for name, column in (("name", "product_name"), ("brand", "brand"), ("price", "price"), ("about", "description"), ("id", "product_id::VARCHAR")):
        html = f"replace({html}, '{{{name}}}', {column})"
    strip = lambda e: rf"trim(regexp_replace({e}, '\s*<[^>]*>\s*', '', 'g'))"

    def element(selector: str) -> str:
        """The first element with this selector, as none of these holds another of its own tag."""
        attribute = rf'<(\w+)[^>]*data-testid="{selector[14:-2]}"[^>]*>' if selector[0] == "[" else rf'<(\w+)[^>]*class="(?:[^"]* )?{selector[1:]}(?: [^"]*)?"[^>]*>' if selector[0] == "." else f"<({selector})[^>]*>"
        tag = f"regexp_extract(html, '{attribute}', 1)"
        after = f"substring(html, strpos(html, regexp_extract(html, '{attribute}')) + length(regexp_extract(html, '{attribute}')))"
        return f"CASE WHEN {tag} <> '' THEN {strip(f"split_part({after}, '</' || {tag} || '>', 1)")} END"

    ladder = lambda s: f"coalesce({', '.join(map(element, s))}, '')"
    # no block of these pages holds another, so a text's element is its block, or what it has of small print within
    tag = "(?:p|section|div|h1|h2|em|span)"
    blocks = f"list_filter(list_transform(regexp_extract_all(html, '<{tag}[^>]*>.*?</{tag}>'), lambda b: {strip('b')}), lambda x: x <> '')"
    # a comment's words stand for all that the page says, as it is in no element
    noted = lambda w: f"CASE WHEN contains(lower(regexp_extract(html, '<!--(.*?)-->', 1)), '{w}') THEN whole END"
    last = lambda w: f"list_filter(blocks, lambda b: contains(lower(b), '{w}') AND length(b) > 10)[-1]"
    fact = lambda w: f"'{w}=' || coalesce({last(w)}, {noted(w)})"
    spoken = ", ".join(f"{noted(w)}, list_filter(blocks, lambda b: contains(lower(b), '{w}') AND length(b) > 20)[1]" for w in fixed.PAGE_INGREDIENT_WORDS)
    return rf"""WITH {v.GROCERY_SQL}, h AS (SELECT product_id, {html} AS html FROM v_grocery),
b AS (SELECT *, {blocks} AS blocks, {strip(r"regexp_replace(html, '<!--.*?-->', '', 'g')")} AS whole FROM h),
i AS (SELECT *, list_transform(list_filter(regexp_extract_all(html, '<img (?:data-)?src="([^"]*)"', 1), lambda s: contains(s, 'product') OR contains(s, 'item')),
  lambda s: CASE WHEN s[1:2] = '//' THEN 'https:' || s WHEN s[1] = '/' THEN 'https://shop.example.com' || s ELSE s END) AS images FROM b)
SELECT product_id, {ladder(fixed.PAGE_TITLE)} AS title, {ladder(fixed.PAGE_PRICE)} AS price, coalesce(nullif({ladder(fixed.PAGE_INGREDIENTS)}, ''), {spoken}, '') AS ingredients,
  array_to_string(list_filter([{', '.join(map(fact, fixed.PAGE_NUTRITION))}], lambda x: x IS NOT NULL), '; ') AS nutrition, array_to_string(images, ' ') AS images FROM i"""


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields of all crawled pages."""
    found = product_pages(v.read(spark, sf_dir, "pages"))
    return found.select("page_id", "title", "price", "ingredients", F.size("nutrition").alias("facts"), F.size("images").alias("images"))


QUERIES = {"product_page": (product_page, _product_page_sql()), "page_fields": (page_fields, None)}
