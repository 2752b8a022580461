"""Matching, conflicts, merging, category rules and knowledge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.plans import views as v
from larder.operators.matching import conflicts, tiered, tiered_wide
from larder.operators.similar import near_names


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goods by signature: the first of each, how many it stands for, and their price range."""
    g = v.grocery(spark, sf_dir).withColumn("signature", t.signature_builder(F.col("brand"), F.col("product_name"), F.col("weight")))
    return g.groupBy("signature").agg(
        F.min("product_id").alias("first"), F.count("*").alias("copies"), F.min("cents").alias("least"), F.max("cents").alias("most")
    )


def _signature_sql() -> str:
    from larder.plans.stats import _WEIGHT, _builder_name_sql

    return f"substring(md5(trim(lower(brand)) || '_' || {_builder_name_sql('product_name')} || '_' || {_WEIGHT}), 1, 16)"


DEDUP_EXACT = f"""WITH {v.GROCERY_SQL}, s AS (SELECT *, {_signature_sql()} AS signature FROM v_grocery)
SELECT signature, min(product_id) AS first, count(*) AS copies, min(cents) AS least, max(cents) AS most FROM s GROUP BY signature"""


def dedup_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every product its five best earlier matches of the first tier that has any."""
    p = v.product(spark, sf_dir).select("product_id", "product_name", "brand", "weight")
    return tiered(p, p, earlier=True)


DEDUP_TIERED = f"""WITH {v.PRODUCT},
m AS (SELECT n.product_id AS new_id, o.product_id AS old_id,
  CASE WHEN n.product_name = o.product_name AND n.weight = o.weight THEN 1 WHEN contains(o.product_name, n.product_name) THEN 2 ELSE 3 END AS tier
  FROM v_product n JOIN v_product o ON n.brand = o.brand AND o.product_id < n.product_id),
f AS (SELECT *, min(tier) OVER (PARTITION BY new_id) AS least FROM m)
SELECT new_id, old_id, tier, CASE tier WHEN 1 THEN 100 WHEN 2 THEN 80 ELSE 60 END AS confidence FROM f WHERE tier = least QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY old_id) <= 5"""


def dedup_tiered_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every product its five first earlier matches of the first tier that has any: signature, name in any name, brand in any brand."""
    p = v.product(spark, sf_dir).select("product_id", "product_name", "brand", "weight")
    return tiered_wide(p, p, earlier=True)


def _wide_sql() -> str:
    from larder.plans.stats import _builder_name_sql

    known = " ".join(f"WHEN contains(lower(product_name), '{a}') THEN '{b}'" for a, b in fixed.DEDUP_NAMES)
    plain = rf"trim(regexp_replace(regexp_replace(CASE {known} ELSE lower(product_name) END, '[^\p{{L}}\p{{N}}\s]', '', 'g'), '\s+', ' ', 'g'))"
    return f"""WITH {v.PRODUCT}, s AS (SELECT product_id, {plain} AS plain, lower(product_name) AS name, {_builder_name_sql('product_name')} AS canonical, lower(brand) AS brand,
  trim(lower(brand)) || '_' || plain || '_' || trim(lower(weight)) AS signature FROM v_product),
m AS (SELECT n.product_id AS new_id, o.product_id AS old_id, CASE WHEN n.signature = o.signature THEN 1
  WHEN contains(o.name, n.plain) OR contains(o.canonical, n.plain) THEN 2 WHEN n.brand <> '' AND contains(o.brand, n.brand) THEN 3 END AS tier
  FROM s n JOIN s o ON o.product_id < n.product_id),
f AS (SELECT *, min(tier) OVER (PARTITION BY new_id) AS least FROM m WHERE tier IS NOT NULL)
SELECT new_id, old_id, tier, CASE tier WHEN 1 THEN 100 WHEN 2 THEN 80 ELSE 60 END AS confidence FROM f WHERE tier = least QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY old_id) <= 5"""


def dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts of each offer with its catalogue product, and what follows."""
    return conflicts(v.offer(spark, sf_dir), v.product(spark, sf_dir))


DEDUP_CONFLICTS = f"""WITH {v.OFFER}, {v.PRODUCT}, j AS (SELECT o.offer_id, o.product_id, abs(o.cents - p.cents) AS diff, o.brand <> p.brand AND o.brand <> '' AS b, o.weight <> p.weight AS w
  FROM v_offer o JOIN v_product p USING (product_id)),
l AS (SELECT *, (diff > 10)::INT + b::INT + w::INT AS conflicts, diff > 100 AS asks FROM j)
SELECT offer_id, product_id, conflicts, asks, CASE WHEN conflicts = 0 THEN 'none' WHEN asks THEN 'ask' ELSE 'update' END AS action,
  concat_ws(',', CASE WHEN diff > 10 THEN 'price' END, CASE WHEN b THEN 'brand' END, CASE WHEN w THEN 'weight' END) AS kinds FROM l"""


def pending_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conflicts of each product wait for an answer, with what the catalogue says."""
    asks = conflicts(v.offer(spark, sf_dir), v.product(spark, sf_dir)).where("action = 'ask'")
    waiting = asks.groupBy("product_id").agg(F.count("*").alias("waiting"))
    return waiting.join(v.product(spark, sf_dir), "product_id", "left").select("product_id", "product_name", "price", "waiting")


PENDING_CONFLICTS = f"""WITH {v.OFFER}, {v.PRODUCT} SELECT product_id, p.product_name, p.price, count(*) AS waiting
FROM v_offer o JOIN v_product p USING (product_id) WHERE abs(o.cents - p.cents) > 100 GROUP BY ALL"""


def merge_fill_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with blanks filled from the latest offer that has them."""
    p = v.product(spark, sf_dir).withColumn("brand", F.when(F.col("product_id") % 3 == 0, F.lit("")).otherwise(F.col("brand")))
    offers = v.offer(spark, sf_dir)
    latest = offers.groupBy("product_id").agg(
        F.max_by(F.when(F.col("brand") != "", F.col("brand")), F.when(F.col("brand") != "", F.struct("seen_at", "offer_id"))).alias("offered_brand"),
        F.max_by("cents", F.struct("seen_at", "offer_id", "cents")).alias("offered_cents"),
    )
    return p.join(latest, "product_id", "left").select(
        "product_id", "product_name", t.falsy(F.col("brand"), F.col("offered_brand")).alias("brand"), F.coalesce("offered_cents", "cents").alias("cents")
    )


MERGE_FILL_BLANKS = f"""WITH {v.OFFER}, {v.PRODUCT}, l AS (SELECT product_id, last(brand ORDER BY seen_at, offer_id) FILTER (WHERE brand <> '') AS ob,
  last(cents ORDER BY seen_at, offer_id, cents) AS oc FROM v_offer GROUP BY product_id)
SELECT product_id, product_name, coalesce(nullif(CASE WHEN product_id % 3 = 0 THEN '' ELSE brand END, ''), ob) AS brand, coalesce(oc, cents) AS cents FROM v_product LEFT JOIN l USING (product_id)"""


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price changes of each product in time, with the price before."""
    order = Window.partitionBy("product_id").orderBy("seen_at", "offer_id", "cents")
    h = v.offer(spark, sf_dir).withColumn("before", F.lag("cents").over(order))
    changed = h.where("before is null or before <> cents")
    return changed.groupBy("product_id").agg(
        F.count("*").alias("changes"), F.min("cents").alias("least"), F.max("cents").alias("most"),
        F.max(F.when(F.col("before").isNotNull(), F.col("cents") - F.col("before"))).alias("largest_rise"),
    )


PRICE_HISTORY = f"""WITH {v.OFFER}, h AS (SELECT product_id, cents, lag(cents) OVER (PARTITION BY product_id ORDER BY seen_at, offer_id, cents) AS before FROM v_offer)
SELECT product_id, count(*) AS changes, min(cents) AS least, max(cents) AS most, max(cents - before) AS largest_rise FROM h WHERE before IS NULL OR before <> cents GROUP BY product_id"""


def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of distinct names of one brand by edit distance, in whole percent; blocked by brand.

    Names, not products, are paired: a brand's products share few names.
    """
    names = v.product(spark, sf_dir).select("brand", "product_name").distinct()
    a, b = names.select("brand", F.col("product_name").alias("a")), names.select("brand", F.col("product_name").alias("b"))
    pairs = a.join(b, "brand").where("a < b")
    near = F.floor(t.similarity(F.col("a"), F.col("b")) * 100)
    return pairs.select("brand", "a", "b", near.alias("similarity"), t.word_jaccard(F.col("a"), F.col("b")).alias("words")).where("similarity >= 60 or words >= 51")


NAME_SIMILARITY = f"""WITH {v.PRODUCT}, n AS (SELECT DISTINCT brand, product_name FROM v_product),
p AS (SELECT x.brand, x.product_name AS a, y.product_name AS b, list_distinct(string_split(x.product_name, ' ')) AS wa, list_distinct(string_split(y.product_name, ' ')) AS wb
  FROM n x JOIN n y ON x.brand = y.brand AND x.product_name < y.product_name),
s AS (SELECT *, floor((1 - levenshtein(a, b)::DOUBLE / greatest(length(a), length(b))) * 100)::BIGINT AS similarity, len(list_intersect(wa, wb)) AS common FROM p),
w AS (SELECT *, CASE WHEN common = 0 THEN 50 ELSE floor(100.0 * common / (len(wa) + len(wb) - common))::INT END AS words FROM s)
SELECT brand, a, b, similarity, words FROM w WHERE similarity >= 60 OR words >= 51"""


def name_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a brand's distinct names that may be one name's variations: edit distance of at most a fifth of the longer."""
    names = v.product(spark, sf_dir).where("product_name is not null").select("brand", F.lower("product_name").alias("name")).distinct()
    return near_names(names, "brand", "name", 0.8).select("brand", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.floor(F.col("similarity") * 1000).alias("permille"))


NAME_VARIATION = f"""WITH {v.PRODUCT}, n AS (SELECT DISTINCT brand, lower(product_name) AS name FROM v_product),
p AS (SELECT x.brand, x.name AS a, y.name AS b, 1 - levenshtein(x.name, y.name)::DOUBLE / greatest(length(x.name), length(y.name)) AS s FROM n x JOIN n y ON x.brand = y.brand AND x.name < y.name)
SELECT brand, a, b, floor(s * 1000)::BIGINT AS permille FROM p WHERE s >= 0.8"""

#: main category, subcategory, pattern; (?<!w) stands for a word's border in either engine
RULES = (
    ("Aufschnitt & Brotaufstriche", "Nuss- & Schokoaufstriche", "(nutella|nuss|haselnuss|erdnuss|mandel).*(aufstrich|creme)"),
    ("Obst", "Beeren", "(himbeere|erdbeere|heidelbeere|brombeere)"),
    ("Obst", "Kernobst", "(apfel|birne)"),
    ("Obst", "Exoten", "(banane|ananas|avocado)"),
    ("Milch & Butter", "Milch", "(vollmilch|milch,)"),
    ("Backwaren", "Brot", "(brot|roggen)"),
    ("Getränke", "Wasser & Saft", "(wasser|saft|cola)"),
)


def category_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules met by each product, the strongest category by votes, and whether it overrides what is there.

    The rules are one expression each, built from a fixed list; no join.
    """
    g = v.grocery(spark, sf_dir)
    said = F.lower(F.concat_ws(" ", "product_name", "brand", "description"))
    hits = F.filter(
        F.array(*[F.when(said.rlike(p), F.struct(F.lit(i).alias("i"), F.lit(m).alias("main"), F.lit(s).alias("sub"))) for i, (m, s, p) in enumerate(RULES)]), lambda x: x.isNotNull()
    )
    many = F.size(F.regexp_extract_all(said, F.lit("(bio|frisch|natur|extra|saft|milch)"), 1))
    strength = F.least(F.lit(100), 50 + F.when(many > 1, 20).otherwise(0) + F.when(F.size("hits") > 1, 20).otherwise(0) + F.when(many > 0, 10).otherwise(0))
    first = F.try_element_at(F.col("hits"), F.lit(1))
    return g.withColumn("hits", hits).select(
        "product_id", F.size("hits").alias("rules"), first["main"].alias("main"), first["sub"].alias("sub"),
        F.when(F.size("hits") > 0, strength).otherwise(0).alias("strength"), ((F.size("hits") > 0) & (strength >= 70)).alias("overrides"),
    )


def _rules_sql() -> str:
    said = "lower(product_name || ' ' || brand || ' ' || description)"
    hit = [f"regexp_matches(said, '{p}')" for _, _, p in RULES]
    first = lambda k: "CASE " + " ".join(f"WHEN {h} THEN '{r[k]}'" for h, r in zip(hit, RULES)) + " END"
    return f"""WITH {v.GROCERY_SQL}, s AS (SELECT product_id, {said} AS said FROM v_grocery),
h AS (SELECT *, ({' + '.join(f'({x})::INT' for x in hit)})::INT AS rules, {first(0)} AS main, {first(1)} AS sub, len(regexp_extract_all(said, '(bio|frisch|natur|extra|saft|milch)')) AS many FROM s),
t AS (SELECT *, CASE WHEN rules > 0 THEN least(100, 50 + CASE WHEN many > 1 THEN 20 ELSE 0 END + CASE WHEN rules > 1 THEN 20 ELSE 0 END + CASE WHEN many > 0 THEN 10 ELSE 0 END) ELSE 0 END AS strength FROM h)
SELECT product_id, rules, main, sub, strength::INT AS strength, strength >= 70 AS overrides FROM t"""


def category_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per category its sorted brands and how many goods; what a shop with these categories is."""
    g = v.grocery(spark, sf_dir).withColumn("category", F.coalesce(t.category(F.col("description")), F.lit("Unknown")))
    by = g.groupBy("category").agg(F.array_sort(F.collect_set("brand")).alias("b"), F.count("*").alias("goods"))
    shop = by.agg(F.count_if(F.col("category") != "Unknown").alias("known")).select(
        F.when(F.col("known") >= 5, "full_grocery_store").when(F.col("known") >= 2, "specialty").otherwise("unknown").alias("shop")
    )
    return by.select("category", F.array_join("b", ",").alias("brands"), "goods", shop.scalar().alias("shop"))


def _category_database_sql() -> str:
    from larder.plans.stats import _category_sql

    return f"""WITH {v.GROCERY_SQL}, c AS (SELECT coalesce({_category_sql('description')}, 'Unknown') AS category, brand FROM v_grocery),
b AS (SELECT category, array_to_string(list_sort(list_distinct(list(brand))), ',') AS brands, count(*) AS goods FROM c GROUP BY category)
SELECT *, CASE WHEN (SELECT count(*) FROM b WHERE category <> 'Unknown') >= 5 THEN 'full_grocery_store' ELSE 'specialty' END AS shop FROM b"""


def food_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each shelf word its five best products by score; brand match before name match.

    The shelf words are a fixed list of two dozen; each product is compared with all of them in one pass.
    """
    g = v.grocery(spark, sf_dir)
    items = F.array(*[F.struct(F.lit(n.lower()).alias("item"), F.lit(b.lower()).alias("b")) for n, b, _, _ in v.GROCERY])
    hit = F.filter(items, lambda i: F.contains(F.lower("product_name"), F.split_part(i["item"], F.lit(" "), F.lit(1))))
    rows = g.select("product_id", "brand", "cents", F.explode(hit).alias("i")).select(
        F.col("i.item").alias("item"), "product_id", (F.col("cents") % 101).alias("score"),
        F.when(F.lower("brand") == F.col("i.b"), "exact_brand").otherwise("name_only").alias("match"),
    )
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), "product_id"))
    return rows.withColumn("rank", place).where("rank <= 5")


FOOD_MATCHES = f"""WITH {v.GROCERY_SQL}, m AS (SELECT lower(w.product_name) AS item, g.product_id, g.cents % 101 AS score, CASE WHEN lower(g.brand) = lower(w.brand) THEN 'exact_brand' ELSE 'name_only' END AS match
  FROM v_grocery g JOIN v_words w ON contains(lower(g.product_name), split_part(lower(w.product_name), ' ', 1)))
SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, product_id)::INT AS rank FROM m QUALIFY rank <= 5"""

QUERIES = {
    "dedup_exact": (dedup_exact, DEDUP_EXACT),
    "dedup_tiered": (dedup_tiered, DEDUP_TIERED),
    "dedup_tiered_wide": (dedup_tiered_wide, _wide_sql()),
    "dedup_conflicts": (dedup_conflicts, DEDUP_CONFLICTS),
    "pending_conflicts": (pending_conflicts, PENDING_CONFLICTS),
    "merge_fill_blanks": (merge_fill_blanks, MERGE_FILL_BLANKS),
    "price_history": (price_history, PRICE_HISTORY),
    "name_similarity": (name_similarity, NAME_SIMILARITY),
    "name_variation": (name_variation, NAME_VARIATION),
    "category_rules": (category_rules, _rules_sql()),
    "category_database": (category_database, _category_database_sql()),
    "food_matches": (food_matches, FOOD_MATCHES),
}
