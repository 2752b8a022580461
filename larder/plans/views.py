"""Views that give the driver's tables the shape of catalogue data, in Spark and as SQL.

Prices are text built from whole cents; nothing depends on how an engine prints floats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name, brand, unit, description: invented shelf goods with German spelling
GROCERY = (
    ("Bananen", "Chiquita", "kg", "Bio Bananen aus Ecuador, energie: 95 kcal, eiweiß: 1.1 g, kohlenhydrate: 20 g, fett: 0.2 g"),
    ("Apfel Braeburn", "Rewe", "Stk", "frischer Apfel, enthält Sellerie, 100g: 52 kcal"),
    ("Heidelbeeren", "Bio", "g", "Heidelbeeren bio, protein: 0.7 g"),
    ("Erdbeeren Schale", "Driscoll", "g", "Obst des Tages"),
    ("Avocado", "Alnatura", "Stk", "Avocado naturland, fett: 15 g, brennwert: 160 kcal"),
    ("Ananas extra", "Del Monte", "Stk", "ingredients: pineapple, sugar; water"),
    ("Birne Conference", "EDEKA", "kg", "Birnen, regional"),
    ("Nuss Creme", "Nutella", "g", "Haselnuss Aufstrich, nüsse, milch, soja, 539 kcal per 100g"),
    ("Vollmilch", "Rewe", "l", "milch, 64 kcal per 100g, protein: 3.3 g, fett: 3.5 g"),
    ("Joghurt Natur", "Danone", "g", "joghurt, milch, contains milk and whey"),
    ("Brot Roggen", "Harry", "g", "brot mit weizen, gluten und sesam, contains wheat, barley"),
    ("Schinken", "Rewe Beste Wahl", "g", "wurst, senf"),
    ("Pizza Salami", "Wagner", "g", "tiefkühl pizza, weizen, milch"),
    ("Mineralwasser", "ja!", "l", "wasser, getränke"),
    ("Orangensaft", "Edeka Gut & Günstig", "ml", "saft, 45 kcal per 100g, carbs 10 g"),
    ("Puffer", "Kelloggs", "g", "Kinder frühstück, gluten"),
    ("Himbeeren", "Demeter", "g", "Himbeeren öko"),
    ("Mehl", "Aurora", "kg", "weizen, 1200 kcal per 100g, 340 kcal je packung, brennwert: 340 kcal"),
    ("Tofu", "Vivera", "g", "soja, organic, protein: 12 g"),
    ("Sahne", "Müller", "ml", "sahne, milch, fett: 30 g"),
    ("Lachs", "Iglo", "g", "fisch, gefroren, protein: 20 g"),
    ("Pretzel", "Snyders of Hanover", "g", "snack, wheat and soy"),
    ("Cola", "Coca Cola", "l", "drinks, 42 kcal per 100g"),
    ("Schokolade", "Milka", "g", "milch, haselnuss, hazelnuts, 530 kcal per 100g, fat: 29.5 g"),
)

STATUS = (("signup", "pending"), ("view", "processing"), ("click", "completed"), ("purchase", "completed"), ("error", "failed"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


def _price_text(cents):
    return F.concat(F.floor(cents / 100).cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"), F.lit(" €"))


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        _price_text(_cents("p_retailprice")).alias("price"),
        _cents("p_retailprice").alias("cents"),
        F.concat(F.col("p_size").cast("string"), F.lit("g")).alias("weight"),
        F.col("p_size").alias("size"),
    )


PRODUCT = """v_product AS (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
  (round(p_retailprice * 100)::BIGINT // 100)::VARCHAR || ',' || lpad((round(p_retailprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') || ' €' AS price,
  round(p_retailprice * 100)::BIGINT AS cents, p_size::VARCHAR || 'g' AS weight, p_size AS size FROM part)"""


def grocery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts named after shelf goods, in turn."""
    words = spark.createDataFrame(
        [(k, *row) for k, row in enumerate(GROCERY)], "k int, product_name string, brand string, unit string, description string"
    )
    parts = read(spark, sf_dir, "part").withColumn("k", (F.col("p_partkey") % len(GROCERY)).cast("int"))
    # the vocabulary has two dozen rows, whatever the table
    joined = parts.join(F.broadcast(words), "k")
    cents = 99 + F.col("p_partkey") % 1900
    return joined.select(
        F.col("p_partkey").alias("product_id"), "product_name", "brand", "unit", "description",
        F.concat(F.col("p_size").cast("string"), F.when(F.col("unit") == "Stk", F.lit(" Stk")).otherwise(F.col("unit"))).alias("weight"),
        _price_text(cents).alias("price"), cents.alias("cents"), F.col("p_size").alias("size"),
    )


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


GROCERY_SQL = f"""v_words(k, product_name, brand, unit, description) AS (VALUES {', '.join(f"({k}, {', '.join(map(_quote, row))})" for k, row in enumerate(GROCERY))}),
v_grocery AS (SELECT p_partkey AS product_id, product_name, brand, unit, description,
  p_size::VARCHAR || CASE WHEN unit = 'Stk' THEN ' Stk' ELSE unit END AS weight,
  ((99 + p_partkey % 1900) // 100)::VARCHAR || ',' || lpad(((99 + p_partkey % 1900) % 100)::VARCHAR, 2, '0') || ' €' AS price,
  99 + p_partkey % 1900 AS cents, p_size AS size FROM part JOIN v_words ON k = p_partkey % {len(GROCERY)})"""


def ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screen text of a shelf tile: price, name with brand and weight, unit price."""
    g = grocery(spark, sf_dir)
    return g.withColumn(
        "text",
        F.concat_ws(" | ", "price", F.concat_ws(" ", "product_name", "brand", "weight"), F.concat(_price_text(F.col("cents") * 2), F.lit(" / kg")), F.lit("1kg")),
    )


OCR_SQL = (
    GROCERY_SQL
    + """,
v_ocr AS (SELECT *, price || ' | ' || product_name || ' ' || brand || ' ' || weight || ' | ' ||
  ((cents * 2) // 100)::VARCHAR || ',' || lpad(((cents * 2) % 100)::VARCHAR, 2, '0') || ' € / kg | 1kg' AS text FROM v_grocery)"""
)


def vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What models (suppliers) say about a product, in order."""
    third = F.col("l_suppkey") % 3
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("model"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        F.col("l_returnflag").alias("value"),
        F.col("l_linestatus").alias("other"),
        F.when(third == 2, 10).otherwise(12).alias("weight"),
        F.round(F.col("l_discount") * 100).cast("int").alias("contamination"),
        F.round(F.col("l_quantity")).cast("int").alias("quantity"),
        _cents("l_extendedprice").alias("cents"),
    )


VOTE = """v_vote AS (SELECT l_partkey AS product_id, l_suppkey AS model, l_orderkey * 10 + l_linenumber AS ord, l_returnflag AS value,
  l_linestatus AS other, CASE WHEN l_suppkey % 3 = 2 THEN 10 ELSE 12 END AS weight, round(l_discount * 100)::INT AS contamination,
  round(l_quantity)::INT AS quantity, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem)"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for kv in STATUS for x in kv])
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("file_id"),
        F.col("user_id").alias("worker"),
        F.col("ts").alias("started_at"),
        status[F.col("event_type")].alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration"),
        F.col("event_type"),
        F.col("props"),
    )


REGISTRY = f"""v_registry AS (SELECT event_id AS file_id, user_id AS worker, ts AS started_at,
  CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in STATUS)} END AS status,
  round(value * 100)::BIGINT AS duration, event_type, props FROM events)"""


def job(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    status = (
        F.when(F.col("o_orderstatus") == "P", "pending")
        .when(F.col("l_linestatus") == "F", "completed")
        .when(F.col("l_returnflag") == "R", "failed")
        .otherwise("processing")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("job_id"), F.col("l_linenumber").alias("file_no"), status.alias("status")
    )


JOB = """v_job AS (SELECT o_orderkey AS job_id, l_linenumber AS file_no, CASE WHEN o_orderstatus = 'P' THEN 'pending'
  WHEN l_linestatus = 'F' THEN 'completed' WHEN l_returnflag = 'R' THEN 'failed' ELSE 'processing' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming offers for catalogue products, with another price and weight."""
    lines, parts = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("offer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("brand"),
        (F.round(F.col("p_retailprice") * 100) + F.col("l_linenumber") * 40 - 40).cast("bigint").alias("cents"),
        F.concat((F.col("p_size") + F.when(F.col("l_suppkey") % 7 == 0, 1).otherwise(0)).cast("string"), F.lit("g")).alias("weight"),
        F.col("l_shipdate").alias("seen_at"),
    )


OFFER = """v_offer AS (SELECT l_orderkey * 10 + l_linenumber AS offer_id, l_partkey AS product_id, p_name AS product_name,
  CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE p_brand END AS brand,
  (round(p_retailprice * 100) + l_linenumber * 40 - 40)::BIGINT AS cents,
  (p_size + CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END)::VARCHAR || 'g' AS weight, l_shipdate AS seen_at
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screen boxes of each order, from its lines."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("screen"),
        F.col("l_linenumber").alias("ord"),
        (F.col("l_partkey") % 400).cast("bigint").alias("x"),
        ((F.col("l_suppkey") * 37) % 900).cast("bigint").alias("y"),
        (150 + F.col("l_partkey") % 120).cast("bigint").alias("w"),
        (150 + F.col("l_suppkey") % 140).cast("bigint").alias("h"),
    )


BOX = """v_box AS (SELECT l_orderkey AS screen, l_linenumber AS ord, l_partkey % 400 AS x, (l_suppkey * 37) % 900 AS y,
  150 + l_partkey % 120 AS w, 150 + l_suppkey % 140 AS h FROM lineitem)"""


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = ("wikipedia_main", "brand_official", "open_food_facts", "google_images", "other")
    pick = F.element_at(F.array(*[F.lit(s) for s in sources]), (F.col("l_suppkey") % len(sources) + 1).cast("int"))
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("image_id"),
        pick.alias("source"),
        (F.round(F.col("l_quantity")) * 20).cast("int").alias("width"),
        F.col("l_returnflag").alias("hint"),
    )


IMAGE = """v_image AS (SELECT l_partkey AS product_id, l_orderkey * 10 + l_linenumber AS image_id,
  ['wikipedia_main', 'brand_official', 'open_food_facts', 'google_images', 'other'][(l_suppkey % 5 + 1)::INT] AS source,
  (round(l_quantity) * 20)::INT AS width, l_returnflag AS hint FROM lineitem)"""
