"""Parsers of prices, weights, screen text, nutrition, HTML and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.plans import views as v


def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's price text read in each way, as cents."""
    c = F.col("price")
    cents = lambda x: F.round(x * 100).cast("bigint")
    odd = F.when(F.col("product_id") % 11 == 0, F.lit("n/a")).otherwise(c)
    return v.product(spark, sf_dir).withColumn("odd", odd).select(
        "product_id",
        cents(t.price(F.col("odd"))).alias("nullable"),
        cents(t.price_or_zero(F.col("odd"))).alias("or_zero"),
        cents(t.price_amount(F.col("odd"))).alias("amount"),
        t.price_currency(F.col("odd")).alias("currency"),
        t.eur(F.col("odd")).alias("eur"),
        t.base_price(F.concat("odd", F.lit(" / kg"))).alias("base"),
    )


_ODD = "CASE WHEN product_id % 11 = 0 THEN 'n/a' ELSE price END"
PRICE_PARSE = rf"""WITH {v.PRODUCT}, o AS (SELECT product_id, {_ODD} AS odd FROM v_product),
n AS (SELECT *, round(try_cast(replace(trim(regexp_replace(odd, '[€$]', '', 'g')), ',', '.') AS DOUBLE) * 100)::BIGINT AS nullable FROM o)
SELECT product_id, nullable, coalesce(nullable, 0) AS or_zero, round(try_cast(regexp_extract(replace(odd, ',', '.'), '\d+[.,]?\d*') AS DOUBLE) * 100)::BIGINT AS amount,
  CASE WHEN contains(odd, '€') THEN 'EUR' ELSE '' END AS currency, CASE WHEN odd = 'n/a' THEN '' ELSE odd END AS eur,
  CASE WHEN odd = 'n/a' THEN 'n/a €' ELSE odd END AS base FROM n"""


def ocr_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a shelf tile's screen text."""
    text = F.col("text")
    parts = F.transform(F.split(text, r"\|"), t.strip)
    priced = F.filter(parts, lambda p: F.contains(p, F.lit("€")))
    brands = F.filter(F.array(*[F.lit(b) for b in fixed.OCR_BRANDS]), lambda b: F.contains(F.lower(text), F.lower(b)))
    longest = F.array_max(F.transform(parts, lambda p, i: F.struct(F.char_length(p).alias("n"), (-i).alias("i"), p.alias("p"))))["p"]
    return v.ocr(spark, sf_dir).select(
        "product_id",
        F.element_at(priced, 1).alias("price"),
        F.when(F.size(priced) > 1, F.element_at(priced, -1)).alias("unit_price"),
        longest.alias("longest"),
        t.largest_weight(text).alias("weight"),
        t.weight_in_text(longest).alias("first_weight"),
        F.array_join(brands, ",").alias("brands"),
        F.size(parts).alias("parts"),
        t.is_bio(text).alias("bio"),
    )


_BRANDS = "[" + ", ".join(f"'{b}'" for b in fixed.OCR_BRANDS) + "]"
_W = r"(\d+(?:[.,]\d+)?)\s*(kg|g|ml|l|stk|stück)"
OCR_FIELDS = rf"""WITH {v.OCR_SQL}, p AS (SELECT *, list_transform(string_split(text, '|'), lambda x: trim(x)) AS parts FROM v_ocr),
q AS (SELECT *, list_filter(parts, lambda x: contains(x, '€')) AS priced, regexp_extract_all(lower(text), '{_W}') AS ws,
  list_reduce(parts, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) AS longest FROM p)
SELECT product_id, priced[1] AS price, CASE WHEN len(priced) > 1 THEN priced[-1] END AS unit_price, longest,
  coalesce(list_reduce(ws, lambda a, b: CASE WHEN replace(regexp_extract(b, '\d+(?:[.,]\d+)?'), ',', '.')::DOUBLE > replace(regexp_extract(a, '\d+(?:[.,]\d+)?'), ',', '.')::DOUBLE THEN b ELSE a END), '') AS weight,
  regexp_extract(lower(longest), '{_W}', 1) || regexp_extract(lower(longest), '{_W}', 2) AS first_weight,
  array_to_string(list_filter({_BRANDS}, lambda b: contains(lower(text), lower(b))), ',') AS brands, len(parts)::INT AS parts,
  regexp_matches(lower(text), 'bio|organic|öko|naturland|demeter') AS bio FROM q"""


def nutrition_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("description")
    tenth = lambda n: F.round(t.nutrient(d, n) * 10).cast("bigint").alias(n)
    return v.grocery(spark, sf_dir).select("product_id", *[tenth(n) for n in fixed.NUTRITION])


def _nutrient_sql(name: str) -> str:
    patterns, low, high = fixed.NUTRITION[name]
    got = [f"try_cast(nullif(regexp_extract(lower(description), '{p}', 1), '') AS DOUBLE)" for p in patterns]
    return f"round(coalesce({', '.join(f'CASE WHEN {g} BETWEEN {low} AND {high} THEN {g} END' for g in got)}) * 10)::BIGINT AS {name}"


NUTRITION_EXTRACT = f"WITH {v.GROCERY_SQL} SELECT product_id, {', '.join(map(_nutrient_sql, fixed.NUTRITION))} FROM v_grocery"


def allergens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("description")
    return v.grocery(spark, sf_dir).select(
        "product_id",
        F.array_join(t.allergens_german(d), ",").alias("german"),
        F.array_join(t.allergen_groups(d), ",").alias("groups"),
        F.array_join(t.ingredients(d), ",").alias("ingredients"),
    )


_GERMAN = "[" + ", ".join(f"'{a}'" for a in fixed.ALLERGENS_DE) + "]"
_GROUPS = "[" + ", ".join(f"CASE WHEN {' OR '.join(f"contains(lower(description), '{w}')" for w in ws)} THEN '{g}' END" for g, ws in fixed.ALLERGENS_EN) + "]"
ALLERGENS = rf"""WITH {v.GROCERY_SQL} SELECT product_id,
  array_to_string(list_transform(list_filter({_GERMAN}, lambda a: contains(lower(description), a)), lambda a: upper(a[1]) || a[2:]), ',') AS german,
  array_to_string(list_filter({_GROUPS}, lambda g: g IS NOT NULL), ',') AS groups,
  array_to_string(list_filter(list_transform(string_split(replace(regexp_extract(lower(description), 'ingredients?[:\s]([^.;]+)', 1), ';', ','), ','), lambda x: trim(x)), lambda x: x <> '')[:8], ',') AS ingredients
FROM v_grocery"""


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = v.read(spark, sf_dir, "pages")
    return pages.select("page_id", t.html_text(F.col("html")).alias("text"), t.html_title(F.col("html")).alias("title"), F.substring(F.md5("url"), 1, 16).alias("url_key"))


HTML_TEXT = r"""SELECT page_id, substring(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
  '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 3000) AS text,
  trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '(?s)<[^>]+>', '', 'g')) AS title, substring(md5(url), 1, 16) AS url_key FROM pages"""

#: Snippets of listings; {id} stands for the product's id.
SNIPPETS = (
    "<img alt='x' src='/p/{id}.jpg'><p>x</p><IMG src=\"//cdn.example.net/{id}.png\"><img src='/icons/logo.png'>",
    "<a href='/q.png'><img width=3 src=\"https://img.example.org/{id}.webp\" alt=''></a><img src='rel/{id}.gif'><img data-x='1'>",
    "<p>{id}</p><image src='/q.png'><img\nsrc='/a/{id}1.jpg'><img src='/a/{id}2.jpg'><img src='/a/{id}3.jpg'><img src='/a/ICON.jpg'><img src='/a/{id}4.jpg'><img src='/a/{id}5.jpg'><img src='/a/{id}6.jpg'>",
)


def html_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image URLs of listings' snippets, one of three a product."""
    snippet = F.element_at(F.array(*map(F.lit, SNIPPETS)), (F.col("product_id") % len(SNIPPETS) + 1).cast("int"))
    html = F.replace(snippet, F.lit("{id}"), F.col("product_id").cast("string"))
    urls = t.html_images(html, F.lit("https://shop.example.com/list?x=1"))
    return v.product(spark, sf_dir).select("product_id", F.array_join(urls, " ").alias("urls"), F.size(urls).alias("n"))


_SNIPPETS = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in SNIPPETS) + "]"
_SKIPPED = " OR ".join(f"contains(lower(u), '{w}')" for w in fixed.IMAGE_SKIP_WORDS)
HTML_IMAGES = rf"""WITH {v.PRODUCT}, h AS (SELECT product_id, replace({_SNIPPETS}[(product_id % {len(SNIPPETS)} + 1)::INT], '{{id}}', product_id::VARCHAR) AS html FROM v_product),
-- tags by their brackets, then the src among a tag's words
g AS (SELECT product_id, list_transform(list_filter(string_split(html, '<'), lambda x: lower(x[1:3]) = 'img' AND regexp_matches(x[4], '[^>]')), lambda x: split_part(x, '>', 1)) AS tags FROM h),
s AS (SELECT product_id, list_filter(list_transform(tags, lambda x: regexp_extract(x, '[\s]src=.([^''"]+).', 1)), lambda u: u <> '') AS found FROM g),
u AS (SELECT product_id, list_filter(list_transform(found, lambda u: CASE WHEN u[1:2] = '//' THEN 'https:' || u WHEN u[1] = '/' THEN 'https://shop.example.com' || u ELSE u END),
  lambda u: starts_with(u, 'http') AND NOT ({_SKIPPED}))[:5] AS urls FROM s)
SELECT product_id, array_to_string(urls, ' ') AS urls, len(urls)::INT AS n FROM u"""


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers around a JSON object: the object is cut out, read, and written back."""
    raw = F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))
    rows = v.registry(spark, sf_dir).withColumn("cut", t.json_slice(raw))
    return rows.select(
        "file_id", F.get_json_object("cut", "$.k").try_cast("bigint").alias("k"),
        F.coalesce(F.from_json("cut", "k bigint, missing string")["missing"], F.lit("")).alias("missing"),
        F.to_json(F.from_json("cut", "k bigint")).alias("again"),
    )


JSON_EXTRACT = f"""WITH {v.REGISTRY} SELECT file_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, '' AS missing,
  '{{"k":' || json_extract_string(props, '$.k') || '}}' AS again FROM v_registry"""


def unit_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, brands, search terms and file names in their canonical spelling."""
    g = v.grocery(spark, sf_dir)
    name, brand = F.col("product_name"), F.col("brand")
    return g.select(
        "product_id",
        t.unit(F.col("unit")).alias("unit"),
        t.brand(brand).alias("brand"),
        t.brand_variant(brand).alias("variant"),
        t.search_term(brand, t.name_dedup(name)).alias("term"),
        t.file_name(F.concat_ws("!!", brand, name)).alias("file"),
        t.drop_preamble(F.concat(F.lit("Product name: Aktion "), name)).alias("bare"),
        F.ascii(F.upper(F.substring(name, 1, 1))).alias("initial"),
    )


def _case(text: str, table, otherwise: str) -> str:
    q = lambda s: s.replace("'", "''")
    return f"CASE {' '.join(f"WHEN contains({text}, '{q(a)}') THEN '{q(b)}'" for a, b in table)} ELSE {otherwise} END"


def _lookup(text: str, table, otherwise: str) -> str:
    q = lambda s: s.replace("'", "''")
    return f"CASE {text} {' '.join(f"WHEN '{q(a)}' THEN '{q(b)}'" for a, b in table)} ELSE {otherwise} END"


def _unit_map_sql() -> str:
    from larder.plans.stats import _dedup_name_sql

    name = _dedup_name_sql("product_name")
    file = r"regexp_replace(regexp_replace(brand || '!!' || product_name, '[^A-Za-z0-9_]', '_', 'g'), '_+', '_', 'g')"
    return f"""WITH {v.GROCERY_SQL} SELECT product_id, {_lookup('unit', fixed.UNITS, 'NULL')} AS unit, {_lookup('lower(brand)', fixed.BRANDS, 'brand')} AS brand,
  {_case('lower(brand)', fixed.BRAND_VARIANTS, 'brand')} AS variant, {_case(name, fixed.SEARCH_TERMS, f"brand || ' ' || {name}")} AS term,
  substring(trim({file}, '_'), 1, 50) AS file, product_name AS bare, ascii(product_name) AS initial FROM v_grocery"""


def price_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t.price_in_text(F.col("text"))
    return v.ocr(spark, sf_dir).select(
        "product_id", F.round(found["amount"] * 100).cast("bigint").alias("cents"), found["currency"].alias("currency"),
        F.when(found["amount"].between(0.5, 50.0), True).otherwise(False).alias("plausible"),
    )


PRICE_IN_TEXT = rf"""WITH {v.OCR_SQL}, p AS (SELECT product_id, replace(regexp_extract(text, '(\d+[.,]\d+)\s*€', 1), ',', '.')::DOUBLE AS a FROM v_ocr)
SELECT product_id, round(a * 100)::BIGINT AS cents, 'EUR' AS currency, a BETWEEN 0.5 AND 50.0 AS plausible FROM p"""


def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions with long texts cut, their whole length kept."""
    log = v.read(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    return log.groupBy("role").agg(
        F.count("*").alias("turns"), F.sum(F.char_length(text)).alias("chars"), F.sum(F.char_length(F.substring(text, 1, 500))).alias("kept"),
        F.count_if(F.char_length(text) > 500).alias("cut"),
    )


LOG_SUMMARY = """SELECT role, count(*) AS turns, sum(length(coalesce(text, '')))::BIGINT AS chars, sum(length(substring(coalesce(text, ''), 1, 500)))::BIGINT AS kept,
  count(*) FILTER (WHERE length(text) > 500) AS cut FROM conversations GROUP BY role"""


def answer_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a model's answer can be a product name: length, refusals, explanations, overlap with the prompt, line breaks."""
    answer = F.col("text")
    words = lambda c: F.array_distinct(F.split(F.lower(c), " "))
    refused = F.lit(False)
    for r in (*fixed.REFUSALS, *fixed.EXPLANATIONS):
        refused = refused | F.contains(F.lower(answer), F.lit(r))
    prompt = F.lit("list the name of the product and the brand in this picture")
    overlap = F.size(F.array_intersect(words(answer), words(prompt)))
    lines = F.char_length(answer) - F.char_length(F.replace(answer, F.lit("\n"), F.lit("")))
    ok = F.char_length(answer).between(3, 150) & ~refused & (2 * overlap <= F.size(words(answer))) & (lines <= 2)
    return v.read(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", ok.alias("valid"), overlap.alias("overlap"))


_REFUSED = " OR ".join(f"contains(lower(text), '{r.replace(chr(39), chr(39) * 2)}')" for r in (*fixed.REFUSALS, *fixed.EXPLANATIONS))
ANSWER_VALIDITY = f"""WITH w AS (SELECT *, list_distinct(string_split(lower(text), ' ')) AS ws,
  string_split('list the name of the product and the brand in this picture', ' ') AS ps FROM conversations WHERE text IS NOT NULL),
o AS (SELECT *, len(list_filter(ws, lambda x: list_contains(ps, x)))::INT AS overlap FROM w)
SELECT conv_id, turn, length(text) BETWEEN 3 AND 150 AND NOT ({_REFUSED}) AND 2 * overlap <= len(ws) AND length(text) - length(replace(text, chr(10), '')) <= 2 AS valid, overlap FROM o"""

QUERIES = {
    "price_parse": (price_parse, PRICE_PARSE),
    "ocr_fields": (ocr_fields, OCR_FIELDS),
    "nutrition_extract": (nutrition_extract, NUTRITION_EXTRACT),
    "allergens": (allergens, ALLERGENS),
    "html_text": (html_text, HTML_TEXT),
    "html_images": (html_images, HTML_IMAGES),
    "json_extract": (json_extract, JSON_EXTRACT),
    "unit_map": (unit_map, _unit_map_sql()),
    "price_in_text": (price_in_text, PRICE_IN_TEXT),
    "log_summary": (log_summary, LOG_SUMMARY),
    "answer_validity": (answer_validity, ANSWER_VALIDITY),
}
