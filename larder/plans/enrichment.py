"""Enrichment: nutrients, providers, sources, identity, greedy groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.operators.grouping import fuzzy_groups, keep_first_boxes
from larder.plans import views as v

_IDS = [i for i, _ in fixed.NUTRIENT_IDS]


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nutrient facts of products by attribute id; some ids are unknown."""
    votes = v.vote(spark, sf_dir)
    ids = F.array(*[F.lit(i) for i in _IDS], F.lit(999))
    return votes.select("product_id", "ord", F.element_at(ids, (F.col("model") % (len(_IDS) + 1) + 1).cast("int")).alias("attr"), F.col("quantity").alias("value"))


_FACTS = f"""{v.VOTE}, f AS (SELECT product_id, ord, [{', '.join(map(str, [*_IDS, 999]))}][(model % {len(_IDS) + 1} + 1)::INT] AS attr, quantity AS value FROM v_vote)"""


def nutrient_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column a nutrient: the last fact of its attribute id; unknown ids count apart."""
    names = F.create_map(*[F.lit(x) for kv in fixed.NUTRIENT_IDS for x in kv])
    facts = _facts(spark, sf_dir).withColumn("name", names[F.col("attr")])
    last = lambda n: F.max_by("value", F.when(F.col("name") == n, F.struct("ord", "value"))).alias(n)
    return facts.groupBy("product_id").agg(*[last(n) for _, n in fixed.NUTRIENT_IDS], F.count_if(F.col("name").isNull()).alias("unknown"))


NUTRIENT_MAP = f"""WITH {_FACTS} SELECT product_id, {', '.join(f'last(value ORDER BY ord, value) FILTER (WHERE attr = {i}) AS {n}' for i, n in fixed.NUTRIENT_IDS)},
  count(*) FILTER (WHERE attr = 999) AS unknown FROM f GROUP BY product_id"""


def source_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over sources of each product's nutrients, from a map of source to value; keys that end in _100g only."""
    facts = _facts(spark, sf_dir).groupBy("product_id", "attr").agg(F.max("value").alias("value"))
    key = F.concat("attr", F.when(F.col("attr") % 2 == 0, F.lit("_100g")).otherwise(F.lit("_serving")))
    maps = facts.groupBy("product_id").agg(F.map_from_entries(F.collect_list(F.struct(key, "value"))).alias("m"))
    kept = F.map_filter("m", lambda k, _: k.endswith("_100g"))
    values = F.map_values(kept)
    total = F.aggregate(values, F.lit(0), lambda a, x: a + x)
    return maps.select("product_id", F.size(values).alias("sources"), F.when(F.size(values) > 0, F.floor(total / F.size(values))).alias("mean"))


SOURCE_MEAN = f"""WITH {_FACTS}, g AS (SELECT product_id, attr, max(value) AS value FROM f GROUP BY ALL)
SELECT product_id, (count(*) FILTER (WHERE attr % 2 = 0))::INT AS sources, floor(avg(value) FILTER (WHERE attr % 2 = 0))::BIGINT AS mean FROM g GROUP BY product_id"""


def optimal_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product the provider with the best balance of cost, speed and quality, in whole points."""
    votes = v.vote(spark, sf_dir)
    score = F.floor(F.lit(4000) / (F.col("quantity") + 1)) + 3 * (F.col("ord") % 10) + 3 * F.floor((100 - F.col("contamination")) / 10)
    best = F.max(F.struct(score.alias("score"), (-F.col("model")).alias("m")))
    return votes.groupBy("product_id").agg(best.alias("b"), F.sum("quantity").alias("cost")).select(
        "product_id", (-F.col("b.m")).alias("provider"), F.col("b.score").alias("score"), F.when(F.col("cost") >= 60, F.concat(F.floor(F.col("cost") / 60).cast("string"), F.lit(" min"))).otherwise(F.concat(F.col("cost").cast("string"), F.lit(" s"))).alias("estimate")
    )


OPTIMAL_PROVIDER = f"""WITH {v.VOTE}, s AS (SELECT product_id, model, quantity, floor(4000.0 / (quantity + 1))::BIGINT + 3 * (ord % 10) + 3 * floor((100 - contamination) / 10)::BIGINT AS score FROM v_vote)
SELECT product_id, first(model ORDER BY score DESC, model) AS provider, max(score)::BIGINT AS score,
  CASE WHEN sum(quantity) >= 60 THEN floor(sum(quantity) / 60)::BIGINT || ' min' ELSE sum(quantity) || ' s' END AS estimate FROM s GROUP BY product_id"""


def model_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that a product's answers lack of the required three, and how bad that is."""
    loaded = v.vote(spark, sf_dir).groupBy("product_id").agg(F.collect_set((F.col("model") % 30).cast("int")).alias("loaded"))
    missing = F.array_except(F.array(F.lit(0), F.lit(7), F.lit(14)), F.col("loaded"))
    severity = F.when(F.size(missing) == 0, "success").when(F.size(missing) == 1, "info").when(F.size(missing) == 2, "warning").otherwise("critical")
    return loaded.select("product_id", F.array_join(missing, ",").alias("missing"), severity.alias("severity"))


MODEL_AVAILABILITY = f"""WITH {v.VOTE}, l AS (SELECT product_id, list(DISTINCT (model % 30)::INT) AS loaded FROM v_vote GROUP BY product_id),
m AS (SELECT product_id, list_filter([0, 7, 14], lambda x: NOT list_contains(loaded, x)) AS missing FROM l)
SELECT product_id, array_to_string(missing, ',') AS missing, CASE len(missing) WHEN 0 THEN 'success' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' ELSE 'critical' END AS severity FROM m"""


def identity_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand spelling, product type and how sure the identity is, in whole percent."""
    g = v.grocery(spark, sf_dir)
    low = F.lower(F.concat_ws(" ", "product_name", "brand", "description"))
    spelled = t.first_hit(F.lower("brand"), fixed.BRAND_SPELLINGS, F.lit(None).cast("string"))
    kind = t.first_hit(low, fixed.PRODUCT_TYPES, F.lit("unknown"))
    base = F.when(t.contains_any(low, fixed.FOOD_WORDS) | t.contains_any(low, fixed.DRINK_WORDS), 80).otherwise(30)
    sure = F.least(F.lit(100), base + F.when(spelled.isNotNull(), 20).otherwise(0) + F.when(kind != "unknown", 10).otherwise(0))
    return g.select("product_id", spelled.alias("brand"), kind.alias("kind"), sure.alias("confidence"))


def _identity_sql() -> str:
    q = lambda s: s.replace("'", "''")
    case = lambda x, table, other: f"CASE {' '.join(f"WHEN contains({x}, '{a}') THEN '{q(b)}'" for a, b in table)} ELSE {other} END"
    return f"""WITH {v.GROCERY_SQL}, l AS (SELECT product_id, lower(brand) AS b, lower(product_name || ' ' || brand || ' ' || description) AS low FROM v_grocery),
c AS (SELECT product_id, {case('b', fixed.BRAND_SPELLINGS, 'NULL')} AS brand, {case('low', fixed.PRODUCT_TYPES, "'unknown'")} AS kind,
  CASE WHEN regexp_matches(low, '{'|'.join((*fixed.FOOD_WORDS, *fixed.DRINK_WORDS))}') THEN 80 ELSE 30 END AS base FROM l)
SELECT product_id, brand, kind, least(100, base + CASE WHEN brand IS NULL THEN 0 ELSE 20 END + CASE WHEN kind = 'unknown' THEN 0 ELSE 10 END)::INT AS confidence FROM c"""


def first_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product the first offer of the first retailer (supplier nation) in order that has one."""
    lines, supplier = v.read(spark, sf_dir, "lineitem"), v.read(spark, sf_dir, "supplier")
    hits = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").alias("product_id"), F.col("s_nationkey").alias("retailer"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("page"),
    )
    return hits.groupBy("product_id").agg(F.min(F.struct("retailer", "page")).alias("f"), F.count("*").alias("hits")).select("product_id", "f.retailer", "f.page", "hits")


FIRST_RETAILER = """SELECT l_partkey AS product_id, first(s_nationkey ORDER BY s_nationkey, l_orderkey * 10 + l_linenumber) AS retailer,
  first(l_orderkey * 10 + l_linenumber ORDER BY s_nationkey, l_orderkey * 10 + l_linenumber) AS page, count(*) AS hits FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey"""


def zipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text's words and its numbers by position, cut to the shorter list: how many pairs, and the longest word with its place and number."""
    words = F.filter(F.split("text", " "), lambda w: (w != "|") & (w != ""))
    numbers = F.regexp_extract_all("text", F.lit(r"\d+"), 0)
    rows = v.ocr(spark, sf_dir).select("product_id", F.arrays_zip(words.alias("w"), numbers.alias("x")).alias("all"))
    pairs = F.filter("all", lambda z: z["w"].isNotNull() & z["x"].isNotNull())
    best = F.array_max(F.transform(pairs, lambda z, k: F.struct(F.char_length(z["w"]).alias("n"), (-k).alias("k"), z["w"].alias("w"), z["x"].alias("x"))))
    return rows.select("product_id", F.size(pairs).alias("n"), best.alias("b")).select("product_id", "n", F.col("b.w").alias("longest"), (1 - F.col("b.k")).alias("place"), F.col("b.x").alias("number"))


ZIPPED_LINES = rf"""WITH {v.OCR_SQL}, w AS (SELECT product_id, list_filter(string_split(text, ' '), lambda x: x <> '|' AND x <> '') AS ws, regexp_extract_all(text, '\d+') AS xs FROM v_ocr),
u AS (SELECT product_id, ws[k] AS w, xs[k] AS x, k, least(len(ws), len(xs)) AS n FROM (SELECT *, unnest(generate_series(1, least(len(ws), len(xs)))) AS k FROM w))
SELECT product_id, any_value(n)::INT AS n, first(w ORDER BY length(w) DESC, k) AS longest, first(k ORDER BY length(w) DESC, k)::INT AS place, first(x ORDER BY length(w) DESC, k) AS number FROM u GROUP BY product_id"""


def component_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components of every screen, by prefix."""
    return prefixed(v.box(spark, sf_dir))


def prefixed(boxes: DataFrame) -> DataFrame:
    """Components whose id holds "component_n" for a screen's n, so 1 meets 10 as well; the first of each."""
    b = boxes.select("screen", F.col("ord"), F.concat(F.lit("component_"), F.col("x").cast("string")).alias("component"))
    asked = b.select("screen", (F.col("ord") % 3).alias("n")).distinct()
    met = asked.join(b, "screen").where(F.contains("component", F.concat(F.lit("component_"), F.col("n").cast("string"))))
    return met.groupBy("screen", "n").agg(F.count("*").alias("matches"), F.min_by("component", F.struct("ord", "component")).alias("first"))


COMPONENT_PREFIX = f"""WITH {v.BOX}, b AS (SELECT screen, ord, 'component_' || x AS component FROM v_box), a AS (SELECT DISTINCT screen, ord % 3 AS n FROM b)
SELECT a.screen, n, count(*) AS matches, first(component ORDER BY ord, component) AS first FROM a JOIN b ON a.screen = b.screen AND contains(component, 'component_' || n) GROUP BY a.screen, n"""


def greedy_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screen's boxes without those that overlap an earlier kept one by more than a tenth of their union."""
    return keep_first_boxes(v.box(spark, sf_dir), most=0.1).select("screen", "ord", "x", "y", "w", "h")


def greedy_boxes_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screen's boxes without those of which an earlier kept one covers more than half."""
    return keep_first_boxes(v.box(spark, sf_dir), of="own").select("screen", "ord", "x", "y", "w", "h")


def _greedy_sql(too_much: str) -> str:
    """Box by box over a screen, with the kept ones so far in a list."""
    shared = "greatest(least(k.x + k.w, b.x + b.w) - greatest(k.x, b.x), 0) * greatest(least(k.y + k.h, b.y + b.h) - greatest(k.y, b.y), 0)"
    box = "struct_pack(ord := b.ord, x := b.x, y := b.y, w := b.w, h := b.h)"
    return f"""WITH RECURSIVE {v.BOX}, b AS (SELECT *, row_number() OVER (PARTITION BY screen ORDER BY ord, x, y, w, h) AS place FROM v_box),
f AS (SELECT screen, place, [{box}] AS kept FROM b WHERE place = 1 UNION ALL
  SELECT b.screen, b.place, CASE WHEN len(list_filter(f.kept, lambda k: {too_much.format(shared=shared)})) > 0 THEN f.kept ELSE list_append(f.kept, {box}) END
  FROM f JOIN b ON b.screen = f.screen AND b.place = f.place + 1),
l AS (SELECT screen, unnest(arg_max(kept, place)) AS k FROM f GROUP BY screen)
SELECT screen, k.ord AS ord, k.x AS x, k.y AS y, k.w AS w, k.h AS h FROM l"""


GREEDY_BOXES = _greedy_sql("10 * {shared} > k.w * k.h + b.w * b.h - {shared}")
GREEDY_BOXES_OWN = _greedy_sql("2 * {shared} > b.w * b.h")


def fuzzy_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a brand in groups of similar spelling."""
    p = v.grocery(spark, sf_dir).select("brand", F.concat_ws(" ", "product_name", "weight").alias("name")).distinct()
    order = F.row_number().over(Window.partitionBy("brand").orderBy("name"))
    return fuzzy_groups(p.withColumn("place", order), "brand", "name", "place")


QUERIES = {
    "nutrient_map": (nutrient_map, NUTRIENT_MAP),
    "source_mean": (source_mean, SOURCE_MEAN),
    "optimal_provider": (optimal_provider, OPTIMAL_PROVIDER),
    "model_availability": (model_availability, MODEL_AVAILABILITY),
    "identity_confidence": (identity_confidence, _identity_sql()),
    "first_retailer": (first_retailer, FIRST_RETAILER),
    "zipped_lines": (zipped_lines, ZIPPED_LINES),
    "component_prefix": (component_prefix, COMPONENT_PREFIX),
    "greedy_boxes": (greedy_boxes, GREEDY_BOXES),
    "greedy_boxes_own": (greedy_boxes_own, GREEDY_BOXES_OWN),
    "fuzzy_group": (fuzzy_group, None),
}
