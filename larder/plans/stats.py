"""Catalogue statistics, search, paging and detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import text as t
from larder.plans import views as v

AS_OF = "2002-01-01"


def catalogue_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top brands of the de-duplicated catalogue, with the mean of positive prices in cents."""
    p = v.product(spark, sf_dir).withColumn("signature", t.signature_simple(F.col("brand"), t.name_simple(F.col("product_name")), F.col("weight")))
    first = p.groupBy("signature").agg(F.min_by(F.struct("brand", "cents"), "product_id").alias("r")).select("r.*")
    return (
        first.where("brand is not null and brand <> ''")
        .groupBy("brand")
        .agg(F.count("*").alias("products"), F.floor(F.avg(F.when(F.col("cents") > 0, F.col("cents")))).alias("mean_cents"))
        .orderBy(F.col("products").desc(), "brand")
        .limit(5)
    )


def _simple_name_sql(c: str) -> str:
    from larder.functions.fixed import SIMPLE_NAMES

    return f"CASE {' '.join(f"WHEN contains(trim(lower({c})), '{a}') THEN '{b}'" for a, b in SIMPLE_NAMES)} ELSE trim(lower({c})) END"


CATALOGUE_DEDUP = f"""WITH {v.PRODUCT},
s AS (SELECT *, substring(md5(trim(lower(brand)) || '_' || {_simple_name_sql('product_name')} || '_' || trim(lower(weight))), 1, 16) AS signature FROM v_product),
f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY signature ORDER BY product_id) = 1)
SELECT brand, count(*) AS products, floor(avg(cents) FILTER (WHERE cents > 0))::BIGINT AS mean_cents
FROM f WHERE brand <> '' GROUP BY brand ORDER BY products DESC, brand LIMIT 5"""


def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.grocery(spark, sf_dir)
    bio = t.is_bio(F.col("description"))
    return p.agg(
        F.count("*").alias("total"),
        F.count_if(bio).alias("bio"),
        F.floor(F.avg(F.when(F.col("cents") > 0, F.col("cents")))).alias("mean_cents"),
        F.countDistinct(F.lower(F.nullif(F.col("brand"), F.lit("")))).alias("brands"),
        F.floor(100 * F.count_if(bio) / F.greatest(F.count("*"), F.lit(1))).alias("bio_percent"),
        F.min("cents").alias("least_cents"),
        F.max("cents").alias("most_cents"),
    )


_BIO = "regexp_matches(lower(description), 'bio|organic|öko|naturland|demeter')"
CATALOG_STATS = f"""WITH {v.GROCERY_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE {_BIO}) AS bio, floor(avg(cents) FILTER (WHERE cents > 0))::BIGINT AS mean_cents,
  count(DISTINCT lower(nullif(brand, ''))) AS brands, floor(100.0 * count(*) FILTER (WHERE {_BIO}) / greatest(count(*), 1))::BIGINT AS bio_percent,
  min(cents) AS least_cents, max(cents) AS most_cents FROM v_grocery"""


def category_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = v.grocery(spark, sf_dir).withColumn("category", t.category(F.col("description")))
    return g.groupBy("category").agg(F.count("*").alias("products"), F.count_if(F.col("category").isNotNull()).alias("known")).orderBy(
        F.col("products").desc(), "category"
    )


def _category_sql(c: str) -> str:
    from larder.functions.fixed import CATEGORY_WORDS

    return f"CASE {' '.join(f"WHEN {' OR '.join(f"contains(lower({c}), '{w}')" for w in words)} THEN '{name}'" for name, words in CATEGORY_WORDS)} END"


CATEGORY_BREAKDOWN = f"""WITH {v.GROCERY_SQL}, c AS (SELECT {_category_sql('description')} AS category FROM v_grocery)
SELECT category, count(*) AS products, count(category) AS known FROM c GROUP BY category"""


def top_brands_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.product(spark, sf_dir).where(F.col("brand").isNotNull() & (F.col("brand") != ""))
    top = p.groupBy("brand").count().orderBy(F.col("count").desc(), "brand").limit(5)
    return top.select(F.format_string("%s (%d)", "brand", "count").alias("line"))


TOP_BRANDS_TEXT = f"""WITH {v.PRODUCT}, b AS (SELECT brand, count(*) AS n FROM v_product WHERE brand <> '' GROUP BY brand ORDER BY n DESC, brand LIMIT 5)
SELECT brand || ' (' || n || ')' AS line FROM b"""


def products_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.product(spark, sf_dir).withColumn("score", F.col("cents") % 101)
    return p.orderBy(F.col("score").desc(), F.col("size").desc(), "product_id").offset(40).limit(20).select("product_id", "product_name", "price", "score")


PRODUCTS_PAGE = f"""WITH {v.PRODUCT} SELECT product_id, product_name, price, cents % 101 AS score FROM v_product
ORDER BY score DESC, size DESC, product_id LIMIT 20 OFFSET 40"""


def product_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with the words in name, brand or category, A-Z in any case; the best twenty."""
    p = v.product(spark, sf_dir)
    hit = F.lit(False)
    for c in ("product_name", "brand", "category"):
        hit = hit | F.ilike(F.col(c), F.lit("%RING%"))
    return p.where(hit).orderBy(F.col("cents").desc(), "product_id").limit(20).select("product_id", "product_name", "cents")


PRODUCT_SEARCH = f"""WITH {v.PRODUCT} SELECT product_id, product_name, cents FROM v_product
WHERE product_name ILIKE '%RING%' OR brand ILIKE '%RING%' OR category ILIKE '%RING%' ORDER BY cents DESC, product_id LIMIT 20"""


def _image_score():
    from larder.functions.fixed import IMAGE_SOURCES

    base = F.lit(50)
    for name, score in IMAGE_SOURCES:
        base = F.when(F.col("source") == name, score).otherwise(base)
    size = F.when(F.col("width") >= 800, 20).when(F.col("width") >= 400, 10).otherwise(0)
    hint = F.when(F.col("hint") == "A", 30).when(F.col("hint") == "N", 25).otherwise(0)
    return F.least(base + size + hint, F.lit(100))


def _image_score_sql() -> str:
    from larder.functions.fixed import IMAGE_SOURCES

    return (
        f"least(CASE source {' '.join(f"WHEN '{n}' THEN {s}" for n, s in IMAGE_SOURCES)} ELSE 50 END + CASE WHEN width >= 800 THEN 20 WHEN width >= 400 THEN 10 ELSE 0 END"
        " + CASE hint WHEN 'A' THEN 30 WHEN 'N' THEN 25 ELSE 0 END, 100)"
    )


def image_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's five best images, the first of them primary."""
    scored = v.image(spark, sf_dir).withColumn("score", _image_score())
    place = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("score").desc(), "image_id"))
    return scored.withColumn("rank", place).where("rank <= 5").select(
        "product_id", "image_id", "score", "rank", (F.col("rank") == 1).alias("is_primary")
    )


IMAGE_RANK = f"""WITH {v.IMAGE}, s AS (SELECT product_id, image_id, {_image_score_sql()} AS score FROM v_image)
SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY score DESC, image_id)::INT AS rank, rank = 1 AS is_primary FROM s QUALIFY rank <= 5"""


def product_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product with its images (primary first), offers and latest offer, as counts and leading values."""
    p = v.product(spark, sf_dir)
    images = v.image(spark, sf_dir).withColumn("score", _image_score())
    best = images.groupBy("product_id").agg(
        F.count("*").alias("images"), F.max(F.struct("score", (-F.col("image_id")).alias("i"))).alias("b")
    )
    offers = v.offer(spark, sf_dir).groupBy("product_id").agg(
        F.count("*").alias("offers"), F.max_by("cents", F.struct("seen_at", "offer_id")).alias("latest_cents")
    )
    return (
        p.join(best, "product_id", "left")
        .join(offers, "product_id", "left")
        .select(
            "product_id", "product_name", F.coalesce("images", F.lit(0)).alias("images"), (-F.col("b.i")).alias("primary_image"),
            F.coalesce("offers", F.lit(0)).alias("offers"), "latest_cents",
        )
    )


PRODUCT_DETAIL = f"""WITH {v.PRODUCT}, {v.IMAGE}, {v.OFFER},
s AS (SELECT product_id, image_id, {_image_score_sql()} AS score FROM v_image),
b AS (SELECT product_id, count(*) AS images, first(image_id ORDER BY score DESC, image_id) AS primary_image FROM s GROUP BY product_id),
o AS (SELECT product_id, count(*) AS offers, last(cents ORDER BY seen_at, offer_id) AS latest_cents FROM v_offer GROUP BY product_id)
SELECT p.product_id, product_name, coalesce(images, 0) AS images, primary_image, coalesce(offers, 0) AS offers, latest_cents
FROM v_product p LEFT JOIN b USING (product_id) LEFT JOIN o USING (product_id)"""


def needs_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products never offered or last offered 30 whole days ago, by score, lowest first."""
    last = v.offer(spark, sf_dir).groupBy("product_id").agg(F.max("seen_at").alias("last"))
    p = v.product(spark, sf_dir).withColumn("score", F.col("cents") % 101).join(last, "product_id", "left")
    age = F.timestamp_diff("DAY", F.col("last"), F.lit(AS_OF).cast("timestamp"))
    due = p.withColumn("age_days", age).where("score < 80 and (last is null or age_days >= 30)")
    return due.orderBy("score", "product_id").limit(50).select("product_id", "score", "age_days")


NEEDS_ENRICHMENT = f"""WITH {v.PRODUCT}, {v.OFFER}, l AS (SELECT product_id, max(seen_at) AS last FROM v_offer GROUP BY product_id),
d AS (SELECT product_id, cents % 101 AS score, floor(epoch(TIMESTAMP '{AS_OF}' - last) / 86400)::BIGINT AS age_days, last FROM v_product LEFT JOIN l USING (product_id))
SELECT product_id, score, age_days FROM d WHERE score < 80 AND (last IS NULL OR age_days >= 30) ORDER BY score, product_id LIMIT 50"""


def source_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min(100, floor(sources * mean confidence * 50)) of each product; confidence in hundredths."""
    c = v.vote(spark, sf_dir).withColumn("confidence", 100 - F.col("contamination"))
    s = c.groupBy("product_id").agg(F.count("*").alias("sources"), F.sum("confidence").alias("total"))
    return s.select("product_id", "sources", F.least(F.lit(100), F.floor(F.col("total") * 50 / 100)).alias("score"))


SOURCE_SCORE = f"""WITH {v.VOTE} SELECT product_id, count(*) AS sources, least(100, floor(sum(100 - contamination) * 50 / 100)::BIGINT) AS score
FROM v_vote GROUP BY product_id"""


def signature_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, n, w = F.col("brand"), F.col("product_name"), F.col("weight")
    return v.grocery(spark, sf_dir).select(
        "product_id",
        t.signature_builder(b, n, w).alias("builder"),
        t.signature_simple(b, n, w).alias("simple"),
        t.signature_dedup(b, n, w).alias("dedup"),
        t.signature_worker(n, b).alias("worker"),
        t.signature_api(b, n, w).alias("api"),
        t.request_id(n, b, w).alias("request"),
        t.weight_norm(w).alias("weight_norm"),
        t.is_fruit(n).alias("fruit"),
    )


def _builder_name_sql(c: str) -> str:
    from larder.functions.fixed import BUILDER_NAMES

    return f"CASE {' '.join(f"WHEN contains(lower({c}), '{a}') THEN '{b}'" for a, b in BUILDER_NAMES)} ELSE replace(trim(lower({c})), ' ', '_') END"


def _dedup_name_sql(c: str) -> str:
    from larder.functions.fixed import DEDUP_NAMES

    out = f"trim(lower({c}))"
    for a, b in DEDUP_NAMES:
        out = f"replace({out}, '{a}', '{b}')"
    return rf"trim(regexp_replace(regexp_replace({out}, '[^\p{{L}}\p{{N}}\s]', '', 'g'), '\s+', ' ', 'g'))"


_LOW_W = "replace(lower(weight), ' ', '')"
_WEIGHT = rf"CASE WHEN contains({_LOW_W}, 'stk') THEN coalesce(nullif(regexp_extract({_LOW_W}, '\d+'), ''), '1') || 'pcs' WHEN contains({_LOW_W}, 'kg') THEN replace({_LOW_W}, 'ikg', '1kg') ELSE {_LOW_W} END"
_FRUIT = f"regexp_matches({_simple_name_sql('product_name')}, 'banana|apple|blueberries|strawberries|avocado|pineapple|pear')"
SIGNATURE_VARIANTS = f"""WITH {v.GROCERY_SQL}
SELECT product_id, substring(md5(trim(lower(brand)) || '_' || {_builder_name_sql('product_name')} || '_' || {_WEIGHT}), 1, 16) AS builder,
  substring(md5(trim(lower(brand)) || '_' || trim(lower(product_name)) || '_' || trim(lower(weight))), 1, 16) AS simple,
  trim(lower(brand)) || '_' || {_dedup_name_sql('product_name')} || '_' || trim(lower(weight)) AS dedup,
  md5(trim(lower(product_name)) || '|' || trim(lower(brand))) AS worker,
  substring(md5(brand || '_' || product_name || '_' || weight), 1, 16) AS api,
  substring(sha256(product_name || brand || weight), 1, 16) AS request, {_WEIGHT} AS weight_norm, {_FRUIT} AS fruit FROM v_grocery"""

QUERIES = {
    "catalogue_dedup": (catalogue_dedup, CATALOGUE_DEDUP),
    "catalog_stats": (catalog_stats, CATALOG_STATS),
    "category_breakdown": (category_breakdown, CATEGORY_BREAKDOWN),
    "top_brands_text": (top_brands_text, TOP_BRANDS_TEXT),
    "products_page": (products_page, PRODUCTS_PAGE),
    "product_search": (product_search, PRODUCT_SEARCH),
    "image_rank": (image_rank, IMAGE_RANK),
    "product_detail": (product_detail, PRODUCT_DETAIL),
    "needs_enrichment": (needs_enrichment, NEEDS_ENRICHMENT),
    "source_score": (source_score, SOURCE_SCORE),
    "signature_variants": (signature_variants, SIGNATURE_VARIANTS),
}
