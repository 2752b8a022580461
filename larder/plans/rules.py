"""Rule banks: category scores and overrides, screen geometry, answer checks, field quality, snippet prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.plans import views as v

#: as the catalogue's patterns are read: any case, letters of any script are letters
FLAGS = "(?iuU)"
SPREADS = "Aufschnitt & Brotaufstriche"


def category_hits(goods: DataFrame) -> DataFrame:
    """goods with `hits`: (main, sub, k, tenths) for the brand (k = -1, tenths 4) and for each pattern met, in the bank's order.

    A pattern's strength in tenths: 5, and 2 each if it matches more than once, if
    the text has a term of jams, if it has a fruit; at most 10. The bank is an
    expression generated from a fixed list: no join, no row of another table.
    """
    filled = F.filter(F.transform(F.array("product_name", "brand", "description"), t.strip), lambda x: x.isNotNull() & (x != ""))
    goods = goods.withColumn("said", F.array_join(filled, " "))
    bonus = sum(F.when(F.col("said").rlike(FLAGS + p), 2).otherwise(0) for p in (fixed.JAM_TERMS, fixed.JAM_FRUITS))
    goods = goods.withColumn("bonus", bonus)
    own = [
        F.when(F.lower("brand") == b, F.struct(F.lit(m).alias("main"), F.lit(s).alias("sub"), F.lit(-1).alias("k"), F.lit(4).alias("tenths")))
        for b, m, s in fixed.CATEGORY_BRANDS
    ]
    met = []
    for k, (m, s, p) in enumerate(fixed.CATEGORY_PATTERNS):
        many = F.regexp_count("said", F.lit(FLAGS + p)) > 1
        strength = F.least(F.lit(10), 5 + F.when(many, 2).otherwise(0) + F.col("bonus")).cast("int")
        met.append(F.when(F.col("said").rlike(FLAGS + p), F.struct(F.lit(m).alias("main"), F.lit(s).alias("sub"), F.lit(k).alias("k"), strength.alias("tenths"))))
    return goods.withColumn("hits", F.filter(F.array(*own, *met), lambda x: x.isNotNull())).drop("said", "bonus")


def category_strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's matches: category, place in the bank, strength in tenths."""
    hits = category_hits(v.grocery(spark, sf_dir)).select("product_id", F.explode("hits").alias("h"))
    return hits.select("product_id", F.col("h.main").alias("main"), F.col("h.sub").alias("sub"), F.col("h.k").alias("rule"), F.col("h.tenths").alias("tenths"))


def category_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per screen the category with the highest sum (the first met, of equals), its confidence, and whether it replaces what was detected.

    The products of one size stand for a screen. What was detected is not in the
    tables: sizes give the category in turn (one in three is cheese) and tenths of
    confidence.
    """
    goods = category_hits(v.grocery(spark, sf_dir)).select(F.col("size").alias("screen"), "product_id", "hits")
    # sums combine before the shuffle: a row for each screen and category
    scores = (
        goods.select("screen", "product_id", F.explode("hits").alias("h"))
        .groupBy("screen", "h.main", "h.sub")
        .agg(F.sum("h.tenths").alias("score"), F.min(F.struct("product_id", "h.k")).alias("first"))
    )
    best = scores.groupBy("screen").agg(F.min(F.struct((-F.col("score")).alias("s"), "first", "main", "sub")).alias("b"))
    matched = F.exists("hits", lambda h: h["k"] >= 0)
    seen = goods.groupBy("screen").agg(F.count("*").alias("products"), F.count_if(matched).alias("matching"))
    got = seen.join(best, "screen").select(
        "screen", "products", "matching", F.col("b.main").alias("main"), F.col("b.sub").alias("sub"), (-F.col("b.s")).alias("score"),
        F.least(F.lit(1.0), -F.col("b.s") / (F.col("products") * 10)).alias("confidence"),
    )
    cheese, sure = F.col("screen") % 3 == 0, F.col("screen") % 10
    overrides = (F.col("confidence") >= 0.7) | (sure < 5) & (F.col("confidence") >= 0.4) | cheese & (F.col("main") == SPREADS) & (F.col("matching") >= 2)
    return got.withColumn("overrides", overrides)


def _plain(text: str) -> str:
    """SQL's patterns know borders of ASCII words alone, so both sides lose their umlauts."""
    return text.translate(str.maketrans("äöüßé", "aouse"))


def _hits_sql() -> str:
    q = lambda s: s.replace("'", "''")
    plain = "translate(lower(concat_ws(' ', trim(product_name), trim(brand), trim(description))), 'äöüßé', 'aouse')"
    bonus = " + ".join(f"CASE WHEN regexp_matches(said, '{_plain(p)}') THEN 2 ELSE 0 END" for p in (fixed.JAM_TERMS, fixed.JAM_FRUITS))
    brands = [f"SELECT product_id, size, '{q(m)}' AS main, '{q(s)}' AS sub, -1 AS k, 4 AS tenths FROM b WHERE lower(brand) = '{n}'" for n, m, s in fixed.CATEGORY_BRANDS]
    rules = [
        f"SELECT product_id, size, '{q(m)}', '{q(s)}', {k}, least(10, 5 + CASE WHEN len(regexp_extract_all(said, '{_plain(p)}')) > 1 THEN 2 ELSE 0 END + bonus)::INT "
        f"FROM b WHERE regexp_matches(said, '{_plain(p)}')"
        for k, (m, s, p) in enumerate(fixed.CATEGORY_PATTERNS)
    ]
    return f"""WITH {v.GROCERY_SQL}, a AS (SELECT product_id, size, brand, {plain} AS said FROM v_grocery), b AS (SELECT *, {bonus} AS bonus FROM a),
h AS ({' UNION ALL '.join(brands + rules)})"""


CATEGORY_STRENGTHS = f"{_hits_sql()} SELECT product_id, main, sub, k AS rule, tenths FROM h"
CATEGORY_OVERRIDE = f"""{_hits_sql()}, s AS (SELECT size, main, sub, sum(tenths)::BIGINT AS score, min((product_id, k)) AS f FROM h GROUP BY ALL),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY size ORDER BY score DESC, f) = 1),
n AS (SELECT size, count(*) AS products, count(*) FILTER (WHERE product_id IN (SELECT product_id FROM h WHERE k >= 0)) AS matching FROM v_grocery GROUP BY size),
c AS (SELECT n.size AS screen, products, matching, main, sub, score, least(1.0::DOUBLE, score::DOUBLE / (products * 10)) AS confidence FROM n JOIN t USING (size))
SELECT *, confidence >= 0.7::DOUBLE OR (screen % 10 < 5 AND confidence >= 0.4::DOUBLE) OR (screen % 3 = 0 AND main = '{SPREADS}' AND matching >= 2) AS overrides FROM c"""


def section_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screen's two sections and the tiles that start in each.

    The border is the top of the tile below the largest gap between neighbouring
    tops (the upper one of equals); with fewer than three tiles, the middle. Tiles
    meet the sections of their own screen by range.
    """
    top, height = 0, 900
    b = v.box(spark, sf_dir)
    order = Window.partitionBy("screen").orderBy("y")
    gaps = b.select("screen", "y", F.lag("y").over(order).alias("above"))
    cut = gaps.groupBy("screen").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("above").isNotNull(), F.struct((F.col("y") - F.col("above")).alias("gap"), (-F.col("y")).alias("at")))).alias("g")
    )
    border = F.when(F.col("n") >= 3, -F.col("g.at")).otherwise(top + height // 2)
    sections = cut.select("screen", border.alias("border")).select(
        "screen",
        F.explode(F.array(
            F.struct(F.lit(0).alias("section"), F.lit(top).cast("long").alias("y_start"), F.col("border").alias("y_end")),
            F.struct(F.lit(1).alias("section"), F.col("border").alias("y_start"), F.lit(top + height).cast("long").alias("y_end")),
        )).alias("s"),
    ).select("screen", "s.*")
    inside = (F.col("y") >= F.col("y_start")) & (F.col("y") < F.col("y_end"))
    tiles = b.select(F.col("screen").alias("_s"), "y", "ord")
    met = sections.join(tiles, (F.col("screen") == F.col("_s")) & inside, "left")
    return met.groupBy("screen", "section", "y_start", "y_end").agg(F.count("ord").alias("tiles"), F.min("ord").alias("first"))


SECTION_RANGES = f"""WITH {v.BOX}, g AS (SELECT screen, y, y - lag(y) OVER (PARTITION BY screen ORDER BY y) AS gap FROM v_box),
c AS (SELECT screen, CASE WHEN count(*) >= 3 THEN first(y ORDER BY gap DESC NULLS LAST, y) ELSE 450 END AS border FROM g GROUP BY screen),
s AS (SELECT screen, 0 AS section, 0::BIGINT AS y_start, border AS y_end FROM c UNION ALL SELECT screen, 1, border, 900 FROM c)
SELECT s.screen, section, y_start, y_end, count(ord) AS tiles, min(ord) AS first FROM s LEFT JOIN v_box b ON b.screen = s.screen AND y >= y_start AND y < y_end GROUP BY ALL"""


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of a screenshot for each order: some lack a header, content or footer."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    header, content = c % 13 != 0, c % 17 != 0
    return v.read(spark, sf_dir, "orders").select(
        o.alias("screen"), F.when(header, o % 40).alias("header_y"), F.when(header, 150 + c % 500).alias("header_h"),
        F.when(content, F.when(o % 11 == 0, 500 + o % 60).otherwise(531)).alias("content_y"), F.when(content, 600 + (c * 7) % 2000).alias("content_h"),
        F.when(o % 2 == 0, 100).alias("footer_h"), (700 + o % 1000).alias("width"), (1500 + c % 1300).alias("height"),
    )


_LAYOUT = """v_layout AS (SELECT o_orderkey AS screen, CASE WHEN o_custkey % 13 <> 0 THEN o_orderkey % 40 END AS header_y, CASE WHEN o_custkey % 13 <> 0 THEN 150 + o_custkey % 500 END AS header_h,
  CASE WHEN o_custkey % 17 <> 0 THEN CASE WHEN o_orderkey % 11 = 0 THEN 500 + o_orderkey % 60 ELSE 531 END END AS content_y, CASE WHEN o_custkey % 17 <> 0 THEN 600 + (o_custkey * 7) % 2000 END AS content_h,
  CASE WHEN o_orderkey % 2 = 0 THEN 100 END AS footer_h, 700 + o_orderkey % 1000 AS width, 1500 + o_custkey % 1300 AS height FROM orders)"""

#: condition (the same in both engines) and issue, in order; those before the position check come with a hard failure as well
_BEFORE = (
    ("header_h IS NULL", "No header region detected"),
    ("header_h < 200 OR header_h > 600", "Header height outside acceptable range"),
    ("header_y > 30", "Header not at top"),
    ("content_h IS NULL", "No content region detected"),
    ("content_y <> 531", "Incompatible content position"),
)
_AFTER = (
    ("content_h < 800", "Content region too small"),
    ("content_y < header_h - 50", "Content overlaps header"),
    ("height < 1800", "Image too short"),
    ("width < 800", "Image too narrow"),
    ("10 * width > 8 * height", "Not portrait format"),
    ("2 * header_h > content_h", "Header too large relative to content"),
    ("10 * header_h < content_h", "Header too small relative to content"),
    ("10 * (coalesce(header_h, 0) + coalesce(content_h, 0) + coalesce(footer_h, 0)) < 7 * height", "Poor UI coverage"),
)


def header_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a screenshot's regions fit: issues in order, how many are critical (by their words), hard failure by the content's position."""
    found = [F.when(F.expr(c), F.lit(i)) for c, i in _BEFORE] + [F.when(F.expr(f"NOT coalesce(content_y <> 531, false) AND ({c})"), F.lit(i)) for c, i in _AFTER]
    s = _layout(spark, sf_dir).withColumn("issues", F.filter(F.array(*found), lambda x: x.isNotNull()))
    hard = F.coalesce(F.col("content_y") != 531, F.lit(False))
    critical = F.size(F.filter("issues", lambda i: F.lower(i).rlike("|".join(fixed.CRITICAL_ISSUES))))
    return s.select("screen", F.array_join("issues", "; ").alias("issues"), critical.alias("critical"), hard.alias("hard"), (~hard & (critical == 0)).alias("compatible"))


HEADER_GEOMETRY = f"""WITH {_LAYOUT}, i AS (SELECT screen, coalesce(content_y <> 531, false) AS hard, list_filter([
  {', '.join([f"CASE WHEN {c} THEN '{i}' END" for c, i in _BEFORE] + [f"CASE WHEN NOT coalesce(content_y <> 531, false) AND ({c}) THEN '{i}' END" for c, i in _AFTER])}], lambda x: x IS NOT NULL) AS issues FROM v_layout),
c AS (SELECT *, len(list_filter(issues, lambda x: regexp_matches(lower(x), '{'|'.join(fixed.CRITICAL_ISSUES)}')))::INT AS critical FROM i)
SELECT screen, array_to_string(issues, '; ') AS issues, critical, hard, NOT hard AND critical = 0 AS compatible FROM c"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model might say of a tile: its fields, or talk about them, in turn."""
    k = F.col("product_id")
    price = F.element_at(
        F.array(F.lit("I can't see one"), F.lit("The price is 1"), F.col("price"), F.lit(""), F.concat("price", F.lit(" or so, with tax")), F.concat(F.lit("€"), F.replace("price", F.lit(" €"), F.lit(""))), F.lit("none")),
        (k % 7 + 1).cast("int"),
    )
    brand = F.element_at(F.array(F.col("brand"), F.concat(F.lit("**"), F.col("brand")), F.lit("x"), F.concat("brand", F.lit(", "), "description"), F.lit("HTTP 500")), (k % 5 + 1).cast("int"))
    return v.grocery(spark, sf_dir).select("product_id", price.alias("price"), brand.alias("brand"), F.when(k % 9 == 0, F.lit("  ")).otherwise(F.col("product_name")).alias("name"))


_ANSWERS = f"""{v.GROCERY_SQL}, v_answer AS (SELECT product_id,
  ['I can''t see one', 'The price is 1', price, '', price || ' or so, with tax', '€' || replace(price, ' €', ''), 'none'][(product_id % 7 + 1)::INT] AS price,
  [brand, '**' || brand, 'x', brand || ', ' || description, 'HTTP 500'][(product_id % 5 + 1)::INT] AS brand, CASE WHEN product_id % 9 = 0 THEN '  ' ELSE product_name END AS name FROM v_grocery)"""


def answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a price or a brand can be an answer, and whether name and price together can be a tile's data."""
    refused = lambda c: t.contains_any(F.lower(c), fixed.SHORT_REFUSALS)
    p, b = F.col("price"), F.col("brand")
    price = (F.char_length(t.strip(p)) >= 3) & (F.char_length(p) <= 15) & p.rlike(r"\p{Nd}") & ~refused(p) & ~t.contains_any(p, ("**", "The price is"))
    brand = (F.char_length(t.strip(b)) >= 2) & (F.char_length(b) <= 50) & ~refused(b) & ~F.contains(b, F.lit("**"))
    data = (t.strip(F.col("name")) != "") & ((p == "") | p.rlike(r"^€\p{Nd}+[.,]\p{Nd}{2}"))
    return _answers(spark, sf_dir).select("product_id", price.alias("price_ok"), brand.alias("brand_ok"), data.alias("data_ok"))


def _refused_sql(c: str) -> str:
    return " OR ".join(f"contains(lower({c}), '{r.replace(chr(39), chr(39) * 2)}')" for r in fixed.SHORT_REFUSALS)


ANSWER_CHECKS = rf"""WITH {_ANSWERS} SELECT product_id,
  length(trim(price)) >= 3 AND length(price) <= 15 AND regexp_matches(price, '\p{{Nd}}') AND NOT ({_refused_sql('price')}) AND NOT contains(price, '**') AND NOT contains(price, 'The price is') AS price_ok,
  length(trim(brand)) >= 2 AND length(brand) <= 50 AND NOT ({_refused_sql('brand')}) AND NOT contains(brand, '**') AS brand_ok,
  trim(name) <> '' AND (price = '' OR regexp_matches(price, '^€\p{{Nd}}+[.,]\p{{Nd}}{{2}}')) AS data_ok FROM v_answer"""


def quality_tenths(field: str, value) -> F.Column:
    """Tenths of quality of a field's value: 10 for any, more by what the field should hold, 10 less for one character; at least 1, blank 0."""
    x = t.strip(value)
    low, n = F.lower(x), F.char_length(x)
    plus = lambda c, k: F.when(c, k).otherwise(0)
    digit = x.rlike(r"\p{Nd}")
    has = lambda *words: t.contains_any(low, words)
    more = {
        "price": lambda: plus(has("€"), 20) + plus(has(",", "."), 10) + plus(n >= 5, 10),
        "product_name": lambda: n + F.when(n > 20, 20).when(n > 10, 10).otherwise(0),
        "brand": lambda: plus(has(*(b.lower() for b in fixed.QUALITY_BRANDS)), 20) + plus(n > 3, 10),
        "weight": lambda: plus(digit, 20) + plus(has("g", "kg", "ml", "l", "stk", "pack"), 10),
        "unit": lambda: plus(low.isin(*fixed.QUALITY_UNITS), 20),
        "price_per_kg": lambda: plus(has("€"), 20) + plus(digit, 10) + plus(has("/", "per"), 10),
    }[field]()
    return F.when(x.isNull() | (x == ""), 0).otherwise(F.greatest(F.lit(1), 10 + more - plus(n < 2, 10))).cast("int")


QUALITY_FIELDS = ("price", "product_name", "brand", "weight", "unit", "price_per_kg")


def field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every field of the goods, in tenths."""
    g = v.grocery(spark, sf_dir).withColumn("price_per_kg", F.when(F.col("unit") == "Stk", F.lit("")).otherwise(F.concat("price", F.lit("/"), "unit")))
    each = F.array(*[F.struct(F.lit(f).alias("field"), quality_tenths(f, F.col(f)).alias("tenths")) for f in QUALITY_FIELDS])
    return g.select("product_id", F.explode(each).alias("q")).select("product_id", "q.field", "q.tenths")


def _tenths_sql(field: str) -> str:
    """SQL for the quality of x, a trimmed value of a field."""
    has = lambda *words: "(" + " OR ".join(f"contains(lower(x), '{w}')" for w in words) + ")"
    plus = lambda c, k: f"CASE WHEN {c} THEN {k} ELSE 0 END"
    digit = r"regexp_matches(x, '\p{Nd}')"
    more = {
        "price": [plus(has("€"), 20), plus(has(",", "."), 10), plus("length(x) >= 5", 10)],
        "product_name": ["length(x)", "CASE WHEN length(x) > 20 THEN 20 WHEN length(x) > 10 THEN 10 ELSE 0 END"],
        "brand": [plus(has(*(b.lower() for b in fixed.QUALITY_BRANDS)), 20), plus("length(x) > 3", 10)],
        "weight": [plus(digit, 20), plus(has("g", "kg", "ml", "l", "stk", "pack"), 10)],
        "unit": [plus(f"lower(x) IN ({', '.join(f"'{u}'" for u in fixed.QUALITY_UNITS)})", 20)],
        "price_per_kg": [plus(has("€"), 20), plus(digit, 10), plus(has("/", "per"), 10)],
    }
    return f"CASE WHEN x = '' THEN 0 ELSE greatest(1, 10 + {' + '.join(more[field])} - {plus('length(x) < 2', 10)}) END::INT"


def _field_quality_sql() -> str:
    value = lambda f: "CASE WHEN unit = 'Stk' THEN '' ELSE price || '/' || unit END" if f == "price_per_kg" else f
    one = [f"SELECT product_id, '{f}' AS field, {_tenths_sql(f)} AS tenths FROM (SELECT product_id, trim({value(f)}) AS x FROM v_grocery)" for f in QUALITY_FIELDS]
    return f"WITH {v.GROCERY_SQL} {' UNION ALL '.join(one)}"


def select_fields(said: DataFrame, key: str) -> DataFrame:
    """(key, field, value, agree, quality): the value of each field that models' answers come to.

    said: (key, field, value, ord, weight, contamination). The first value that two
    answers share wins; else the one of best quality, then of the heaviest model,
    then the first. Quality is the field's own, in thousandths, less the answer's
    contamination in percent. Blank values are no answers. Values are counted, and
    the best answer of each kept, before a key's values meet. Answers that are dealt
    by their key already are not shuffled again.
    """
    rows = said.withColumn("value", t.strip(F.col("value"))).where("value <> ''")
    own = F.lit(0)
    for f in QUALITY_FIELDS:
        own = F.when(F.col("field") == f, quality_tenths(f, F.col("value"))).otherwise(own)
    rows = rows.withColumn("quality", own * (100 - F.col("contamination")))
    best = F.max(F.struct("quality", "weight", (-F.col("ord")).alias("o")))
    per = rows.groupBy(key, "field", "value").agg(F.count("*").alias("agree"), F.min("ord").alias("first"), best.alias("best"))
    shared = F.min(F.when(F.col("agree") >= 2, F.struct("first", "value", "agree", F.col("best.quality").alias("quality"))))
    alone = F.max(F.struct("best", "value", "agree"))
    found = per.groupBy(key, "field").agg(shared.alias("s"), alone.alias("a"))
    return found.select(
        key, "field", F.coalesce("s.value", "a.value").alias("value"), F.coalesce("s.agree", "a.agree").alias("agree"), F.coalesce("s.quality", "a.best.quality").alias("quality"),
    )


SAID_FIELDS = ("price", "brand", "weight", "unit")


def field_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of each product as the answers on one screen (an order) come to; suppliers are the models, and spell in four ways."""
    lines, parts = v.read(spark, sf_dir, "lineitem"), v.read(spark, sf_dir, "part")
    way, cents = F.col("way"), F.col("cents")
    euros = F.concat((cents / 100).cast("bigint").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    size = F.col("p_size").cast("string")
    pick = lambda *x: F.element_at(F.array(*[F.lit(y) if isinstance(y, str) else y for y in x]), (way + 1).cast("int"))
    values = {
        "price": pick(F.concat(euros, F.lit(" €")), euros, F.concat(F.lit(" "), cents.cast("string")), ""),
        "brand": pick(F.col("p_brand"), F.concat(F.lit("Rewe "), F.col("p_brand")), "x", F.col("p_type")),
        "weight": pick(F.concat(size, F.lit("g")), size, F.concat(size, F.lit(" pack")), "  "),
        "unit": pick("kg", "Stk", "g", "piece"),
    }
    answers = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("screen"), (F.col("l_linenumber") * 1_000_000 + F.col("l_suppkey") * 10 + F.col("l_partkey") % 10).alias("ord"),
        F.when(F.col("l_suppkey") % 3 == 2, 10).otherwise(12).alias("weight"), F.round(F.col("l_discount") * 100).cast("int").alias("contamination"),
        (F.col("l_suppkey") % 4).cast("tinyint").alias("way"), F.floor(F.round(F.col("p_retailprice") * 100)).cast("bigint").alias("cents"), "p_brand", "p_type", "p_size",
    )
    # an order has few lines, so nothing combines before they meet: they are dealt once, as one row for all fields, and stay where they are
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    said = answers.repartition(n, "screen").select(
        "screen", "ord", "weight", "contamination", F.explode(F.create_map(*[x for k in SAID_FIELDS for x in (F.lit(k), values[k])])).alias("field", "value"),
    )
    return select_fields(said, "screen")


def _field_selection_sql() -> str:
    value = {
        "price": "CASE way WHEN 0 THEN euros || ' €' WHEN 1 THEN euros WHEN 2 THEN ' ' || cents ELSE '' END",
        "brand": "CASE way WHEN 0 THEN p_brand WHEN 1 THEN 'Rewe ' || p_brand WHEN 2 THEN 'x' ELSE p_type END",
        "weight": "CASE way WHEN 0 THEN p_size || 'g' WHEN 1 THEN p_size::VARCHAR WHEN 2 THEN p_size || ' pack' ELSE '  ' END",
        "unit": "CASE way WHEN 0 THEN 'kg' WHEN 1 THEN 'Stk' WHEN 2 THEN 'g' ELSE 'piece' END",
    }
    said = " UNION ALL ".join(f"SELECT screen, ord, weight, contamination, '{f}' AS field, trim({value[f]}) AS x FROM r" for f in SAID_FIELDS)
    tenths = "CASE field " + " ".join(f"WHEN '{f}' THEN {_tenths_sql(f)}" for f in SAID_FIELDS) + " END"
    return f"""WITH c AS (SELECT *, floor(round(p_retailprice * 100))::BIGINT AS cents FROM part),
r AS (SELECT l_orderkey AS screen, l_linenumber * 1000000 + l_suppkey * 10 + l_partkey % 10 AS ord, CASE WHEN l_suppkey % 3 = 2 THEN 10 ELSE 12 END AS weight,
  round(l_discount * 100)::INT AS contamination, l_suppkey % 4 AS way, cents, (cents // 100) || ',' || lpad((cents % 100)::VARCHAR, 2, '0') AS euros, p_brand, p_type, p_size FROM lineitem JOIN c ON l_partkey = p_partkey),
s AS ({said}), q AS (SELECT *, {tenths} * (100 - contamination) AS quality FROM s WHERE x <> ''),
n AS (SELECT *, count(*) OVER (PARTITION BY screen, field, x) AS agree, max(quality) OVER (PARTITION BY screen, field, x) AS best FROM q)
SELECT screen, field, x AS value, agree, CASE WHEN agree >= 2 THEN best ELSE quality END::INT AS quality FROM n
QUALIFY row_number() OVER (PARTITION BY screen, field ORDER BY agree >= 2 DESC, CASE WHEN agree >= 2 THEN -ord ELSE quality END DESC, weight DESC, ord, x DESC) = 1"""


def snippet_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per brand the prices found in its snippets: how many, least, most and mean, in cents."""
    cents = F.round(t.price_in_text(F.col("text"))["amount"] * 100).cast("bigint")
    found = v.ocr(spark, sf_dir).select("brand", cents.alias("cents")).where("cents is not null")
    return found.groupBy("brand").agg(F.count("*").alias("prices"), F.min("cents").alias("least"), F.max("cents").alias("most"), (F.sum("cents") / F.count("*")).alias("mean"))


SNIPPET_PRICES = rf"""WITH {v.OCR_SQL}, p AS (SELECT brand, round(replace(regexp_extract(text, '(\d+[.,]\d+)\s*€', 1), ',', '.')::DOUBLE * 100)::BIGINT AS cents FROM v_ocr)
SELECT brand, count(*) AS prices, min(cents) AS least, max(cents) AS most, sum(cents)::DOUBLE / count(*) AS mean FROM p GROUP BY brand"""


def confidence_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text's name and brand where it fits the picture by more than 70, else the picture's; a text without brand takes the picture's."""
    g = v.grocery(spark, sf_dir).withColumns({"fits": F.col("cents") % 101, "seen": F.concat_ws(" ", "brand", "product_name"), "said": F.when(F.col("size") % 4 != 0, F.col("brand"))})
    sure = F.col("fits") > 70
    return g.select(
        "product_id", "fits", F.when(sure, F.col("product_name")).otherwise(F.col("seen")).alias("final_name"),
        F.when(sure, F.coalesce("said", F.upper("brand"))).otherwise(F.upper("brand")).alias("final_brand"),
    )


CONFIDENCE_PICK = f"""WITH {v.GROCERY_SQL} SELECT product_id, cents % 101 AS fits, CASE WHEN cents % 101 > 70 THEN product_name ELSE brand || ' ' || product_name END AS final_name,
  CASE WHEN cents % 101 > 70 AND size % 4 <> 0 THEN brand ELSE upper(brand) END AS final_brand FROM v_grocery"""

QUERIES = {
    "category_strengths": (category_strengths, CATEGORY_STRENGTHS),
    "category_override": (category_override, CATEGORY_OVERRIDE),
    "section_ranges": (section_ranges, SECTION_RANGES),
    "header_geometry": (header_geometry, HEADER_GEOMETRY),
    "answer_checks": (answer_checks, ANSWER_CHECKS),
    "field_quality": (field_quality, _field_quality_sql()),
    "field_selection": (field_selection, _field_selection_sql()),
    "snippet_prices": (snippet_prices, SNIPPET_PRICES),
    "confidence_pick": (confidence_pick, CONFIDENCE_PICK),
}
