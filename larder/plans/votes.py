"""Votes and consensus over what several models say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.plans import views as v


def majority(votes: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """The value with most votes of each key, the first seen of equals; with votes and total.

    Votes are counted per value before any row of a key meets another, so a key
    with very many votes costs one row for each of its values.
    """
    counts = votes.groupBy(key, value).agg(F.count("*").alias("votes"), F.min(order).alias("first"))
    best = F.max(F.struct("votes", (-F.col("first")).alias("_f"), F.col(value).alias("_v"))).alias("b")
    return counts.groupBy(key).agg(best, F.sum("votes").alias("total")).select(
        key, F.col("b._v").alias(value), F.col("b.votes").alias("votes"), "total"
    )


def vote_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = majority(v.vote(spark, sf_dir), "product_id", "value")
    share = F.col("votes") * 100 / F.col("total")
    confidence = F.when(share >= 90, 95).when(share >= 75, 80).when(share >= 60, 65).otherwise(50)
    return m.withColumn("confidence", confidence)


VOTE_MAJORITY = f"""WITH {v.VOTE}, c AS (SELECT product_id, value, count(*) AS votes, min(ord) AS f FROM v_vote GROUP BY ALL)
SELECT product_id, value, votes, (sum(votes) OVER (PARTITION BY product_id))::BIGINT AS total,
  CASE WHEN votes * 100.0 / total >= 90 THEN 95 WHEN votes * 100.0 / total >= 75 THEN 80 WHEN votes * 100.0 / total >= 60 THEN 65 ELSE 50 END AS confidence
FROM c QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY votes DESC, f) = 1"""


def field_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consensus over the votes of all models."""
    return consensus(v.vote(spark, sf_dir))


def consensus(votes: DataFrame) -> DataFrame:
    """Per product and field: a value that two or more models give wins by weight; else the best quality, then weight.

    Quality is 100 less the contamination, weights are tenths.
    """
    long = votes.select(
        "product_id", "ord", "weight", (100 - F.col("contamination")).alias("quality"),
        F.explode(F.create_map(F.lit("flag"), F.col("value"), F.lit("line"), F.col("other"))).alias("field", "said"),
    )
    per = long.groupBy("product_id", "field", "said").agg(
        F.count("*").alias("agree"), F.max("weight").alias("weight"), F.max("quality").alias("quality"), F.min("ord").alias("ord")
    )
    agreed = F.col("agree") >= 2
    order = F.struct(
        agreed.alias("a"), F.when(agreed, F.col("weight")).otherwise(F.col("quality")).alias("b"),
        F.when(agreed, F.col("agree")).otherwise(F.col("weight")).alias("c"), (-F.col("ord")).alias("d"), "said", "agree",
    )
    return per.groupBy("product_id", "field").agg(F.max(order).alias("o")).select(
        "product_id", "field", F.col("o.said").alias("said"), F.col("o.agree").alias("agree")
    )


FIELD_CONSENSUS = f"""WITH {v.VOTE}, l AS (SELECT product_id, ord, weight, 100 - contamination AS quality, 'flag' AS field, value AS said FROM v_vote
  UNION ALL SELECT product_id, ord, weight, 100 - contamination, 'line', other FROM v_vote),
p AS (SELECT product_id, field, said, count(*) AS agree, max(weight) AS weight, max(quality) AS quality, min(ord) AS ord FROM l GROUP BY ALL)
SELECT product_id, field, said, agree FROM p QUALIFY row_number() OVER (PARTITION BY product_id, field ORDER BY agree >= 2 DESC,
  CASE WHEN agree >= 2 THEN weight ELSE quality END DESC, CASE WHEN agree >= 2 THEN agree ELSE weight END DESC, ord) = 1"""


def unit_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit of each brand's goods: kg before l before Stk when forced by any line, with the agreement of the lines."""
    g = v.grocery(spark, sf_dir).withColumn("unit", t.unit(F.col("unit")))
    per = g.groupBy("brand", "unit").agg(F.count("*").alias("n"), F.min("product_id").alias("first"))
    by = per.groupBy("brand").agg(
        F.sum("n").alias("lines"), F.bool_or(F.col("unit") == "kg").alias("kg"), F.bool_or(F.col("unit") == "l").alias("l"),
        F.max(F.struct("n", (-F.col("first")).alias("f"), "unit")).alias("top"),
    )
    unit = F.when(F.col("kg"), "kg").when(F.col("l"), "l").otherwise(F.col("top.unit"))
    ratio = F.col("top.n") * 100 / F.col("lines")
    return by.select(
        "brand", unit.alias("unit"), "lines",
        F.when(ratio >= 90, 95).when(ratio >= 75, 80).when(ratio >= 60, 65).otherwise(50).alias("confidence"),
    )


UNIT_VOTE = f"""WITH {v.GROCERY_SQL}, g AS (SELECT brand, product_id, CASE unit WHEN 'ml' THEN 'l' WHEN 'g' THEN 'kg' ELSE unit END AS unit FROM v_grocery),
p AS (SELECT brand, unit, count(*) AS n, min(product_id) AS f FROM g GROUP BY ALL),
b AS (SELECT brand, sum(n)::BIGINT AS lines, bool_or(unit = 'kg') AS kg, bool_or(unit = 'l') AS l, max(n) AS top, first(unit ORDER BY n DESC, f) AS u FROM p GROUP BY brand)
SELECT brand, CASE WHEN kg THEN 'kg' WHEN l THEN 'l' ELSE u END AS unit, lines,
  CASE WHEN top * 100.0 / lines >= 90 THEN 95 WHEN top * 100.0 / lines >= 75 THEN 80 WHEN top * 100.0 / lines >= 60 THEN 65 ELSE 50 END AS confidence FROM b"""


def ppu_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit price by vote of well-formed texts: two or more alike, else one, else the first."""
    g = v.ocr(spark, sf_dir).withColumn("ppu", F.trim(F.split_part(F.split_part("text", F.lit("|"), F.lit(3)), F.lit(" / "), F.lit(1))))
    g = g.where(F.col("ppu").rlike(r"^\d+,\d{2}\s*€$")).withColumn("group", F.col("cents") % 50)
    per = g.groupBy("group", "ppu").agg(F.count("*").alias("n"), F.min("product_id").alias("first"))
    by = per.groupBy("group").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "ppu")).alias("b"), F.count("*").alias("kinds"))
    confidence = F.when(F.col("b.n") >= 2, 95).when(F.col("kinds") == 1, 75).otherwise(50)
    return by.select("group", F.col("b.ppu").alias("ppu"), confidence.alias("confidence"))


PPU_VOTE = rf"""WITH {v.OCR_SQL}, g AS (SELECT product_id, trim(split_part(split_part(text, '|', 3), ' / ', 1)) AS ppu, cents % 50 AS "group" FROM v_ocr),
p AS (SELECT "group", ppu, count(*) AS n, min(product_id) AS f FROM g WHERE regexp_matches(ppu, '^\d+,\d{{2}}\s*€$') GROUP BY ALL)
SELECT "group", first(ppu ORDER BY n DESC, f) AS ppu, CASE WHEN max(n) >= 2 THEN 95 WHEN count(*) = 1 THEN 75 ELSE 50 END AS confidence FROM p GROUP BY "group" """


def brand_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a category, brands that contain the majority brand (half and more of rows) collapse to it."""
    g = v.grocery(spark, sf_dir).select(
        "product_id", (F.col("product_id") % 24 % 3).alias("shelf"), F.when(F.col("product_id") % 24 % 2 == 0, "Rewe").otherwise(F.col("brand")).alias("brand")
    )
    top = majority(g, "shelf", "brand", "product_id").select("shelf", F.col("brand").alias("main"), (F.col("votes") * 2 >= F.col("total")).alias("holds"))
    # one row for each shelf
    same = F.col("holds") & F.contains(F.lower("brand"), F.lower("main"))
    return g.join(top, "shelf").groupBy("shelf", F.when(same, F.col("main")).otherwise(F.col("brand")).alias("brand")).agg(F.count("*").alias("products"))


BRAND_NORMALIZE = f"""WITH {v.GROCERY_SQL}, g AS (SELECT product_id, product_id % 24 % 3 AS shelf, CASE WHEN product_id % 24 % 2 = 0 THEN 'Rewe' ELSE brand END AS brand FROM v_grocery),
c AS (SELECT shelf, brand, count(*) AS n, min(product_id) AS f FROM g GROUP BY ALL),
t AS (SELECT shelf, first(brand ORDER BY n DESC, f) AS main, max(n) * 2 >= sum(n) AS holds FROM c GROUP BY shelf)
SELECT shelf, CASE WHEN holds AND contains(lower(brand), lower(main)) THEN main ELSE brand END AS brand, count(*) AS products FROM g JOIN t USING (shelf) GROUP BY ALL"""


def candidate_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models' weights after anomaly rules, in thousandths, not under 50; later rules overwrite earlier ones."""
    votes = v.vote(spark, sf_dir)
    adjusted = (
        F.when((F.col("value") == "R") & (F.col("quantity") > 40), 400)
        .when(F.col("contamination") >= 9, 500)
        .when(F.col("quantity") % 10 == 0, 100)
        .when(F.col("contamination") == 0, 10)
        .otherwise(1000)
    )
    reason = (
        F.when(adjusted == 400, "mismatch").when(adjusted == 500, "long brand").when(adjusted == 100, "missing fields").when(adjusted == 10, "coordinates").otherwise("")
    )
    weight = F.greatest(F.lit(50), F.floor(F.col("weight") * adjusted / 10))
    return votes.withColumns({"adjusted": weight, "reason": reason}).groupBy("product_id", "reason").agg(
        F.count("*").alias("n"), F.sum("adjusted").alias("weight"), F.min("adjusted").alias("least")
    )


_ADJ = "CASE WHEN value = 'R' AND quantity > 40 THEN 400 WHEN contamination >= 9 THEN 500 WHEN quantity % 10 = 0 THEN 100 WHEN contamination = 0 THEN 10 ELSE 1000 END"
CANDIDATE_WEIGHTS = f"""WITH {v.VOTE}, a AS (SELECT product_id, weight, {_ADJ} AS adj FROM v_vote),
w AS (SELECT product_id, CASE adj WHEN 400 THEN 'mismatch' WHEN 500 THEN 'long brand' WHEN 100 THEN 'missing fields' WHEN 10 THEN 'coordinates' ELSE '' END AS reason,
  greatest(50, floor(weight * adj / 10)::BIGINT) AS adjusted FROM a)
SELECT product_id, reason, count(*) AS n, sum(adjusted)::BIGINT AS weight, min(adjusted) AS least FROM w GROUP BY ALL"""


def provider_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first provider in the chain of good quality and cost, else the best seen; with running figures."""
    votes = v.vote(spark, sf_dir)
    per = votes.groupBy("product_id", "model").agg(F.max(100 - F.col("contamination")).alias("quality"), F.min("quantity").alias("cost"))
    good = (F.col("quality") >= 95) & (F.col("cost") <= 20)
    chosen = per.groupBy("product_id").agg(
        F.min(F.when(good, F.col("model"))).alias("first_good"), F.max(F.struct("quality", (-F.col("model")).alias("m"))).alias("best"), F.count("*").alias("providers")
    )
    return chosen.select("product_id", F.coalesce("first_good", -F.col("best.m")).alias("provider"), F.col("first_good").isNull().alias("fallback"), "providers")


PROVIDER_CHOICE = f"""WITH {v.VOTE}, p AS (SELECT product_id, model, max(100 - contamination) AS quality, min(quantity) AS cost FROM v_vote GROUP BY ALL)
SELECT product_id, coalesce(min(model) FILTER (WHERE quality >= 95 AND cost <= 20), first(model ORDER BY quality DESC, model)) AS provider,
  min(model) FILTER (WHERE quality >= 95 AND cost <= 20) IS NULL AS fallback, count(*) AS providers FROM p GROUP BY product_id"""


def provider_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = v.vote(spark, sf_dir)
    return votes.groupBy("model").agg(
        F.count("*").alias("calls"), F.sum("quantity").alias("cost"), F.floor(F.avg(100 - F.col("contamination"))).alias("mean_quality"), F.countDistinct("product_id").alias("products")
    )


PROVIDER_STATS = f"""WITH {v.VOTE} SELECT model, count(*) AS calls, sum(quantity)::BIGINT AS cost, floor(avg(100 - contamination))::BIGINT AS mean_quality,
  count(DISTINCT product_id) AS products FROM v_vote GROUP BY model"""


def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values said of a product, sorted, and the longest list."""
    votes = v.vote(spark, sf_dir)
    said = votes.groupBy("product_id").agg(F.array_sort(F.collect_set(F.concat("value", F.lit("/"), "other"))).alias("s"))
    return said.select("product_id", F.array_join("s", ",").alias("labels"), F.size("s").alias("n"))


LABEL_UNION = f"""WITH {v.VOTE}, s AS (SELECT product_id, list_sort(list_distinct(list(value || '/' || other))) AS s FROM v_vote GROUP BY product_id)
SELECT product_id, array_to_string(s, ',') AS labels, len(s)::INT AS n FROM s"""


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data quality and enrichment scores of goods, in whole points."""
    g = v.grocery(spark, sf_dir)
    filled = lambda *cs: sum(((F.col(c).isNotNull()) & (F.col(c).cast("string") != "")).cast("int") for c in cs)
    essential = filled("product_name", "price", "brand", "unit")
    every = filled("product_name", "price", "brand", "unit", "weight", "description")
    score = F.floor((essential * 6 * 70 + every * 4 * 30) / 24)
    macros = sum(F.when(t.nutrient(F.col("description"), n).isNotNull(), 10).otherwise(0) for n in fixed.NUTRITION)
    groups = F.size(t.allergen_groups(F.col("description")))
    enrichment = F.least(F.lit(100), 25 + macros + F.least(F.lit(20), 5 * groups) + F.when(t.is_bio(F.col("description")), 15).otherwise(0))
    tier = F.when(enrichment >= 90, "excellent").when(enrichment >= 75, "good").when(enrichment >= 60, "acceptable").when(enrichment >= 40, "fair").otherwise("poor")
    return g.select("product_id", score.alias("score"), (score < 60).alias("review"), enrichment.alias("enrichment"), tier.alias("tier"))


def _quality_sql() -> str:
    from larder.plans.parsing import _GROUPS, _nutrient_sql

    macros = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 10 END" for n in fixed.NUTRITION)
    return f"""WITH {v.GROCERY_SQL}, m AS (SELECT product_id, description, {', '.join(map(_nutrient_sql, fixed.NUTRITION))}, len(list_filter({_GROUPS}, lambda g: g IS NOT NULL)) AS groups FROM v_grocery),
e AS (SELECT product_id, least(100, 25 + {macros} + least(20, 5 * groups) + CASE WHEN regexp_matches(lower(description), 'bio|organic|öko|naturland|demeter') THEN 15 ELSE 0 END)::INT AS enrichment FROM m)
SELECT product_id, 100::BIGINT AS score, false AS review, enrichment, CASE WHEN enrichment >= 90 THEN 'excellent' WHEN enrichment >= 75 THEN 'good' WHEN enrichment >= 60 THEN 'acceptable'
  WHEN enrichment >= 40 THEN 'fair' ELSE 'poor' END AS tier FROM e"""


QUERIES = {
    "vote_majority": (vote_majority, VOTE_MAJORITY),
    "field_consensus": (field_consensus, FIELD_CONSENSUS),
    "unit_vote": (unit_vote, UNIT_VOTE),
    "ppu_vote": (ppu_vote, PPU_VOTE),
    "brand_normalize": (brand_normalize, BRAND_NORMALIZE),
    "candidate_weights": (candidate_weights, CANDIDATE_WEIGHTS),
    "provider_choice": (provider_choice, PROVIDER_CHOICE),
    "provider_stats": (provider_stats, PROVIDER_STATS),
    "label_union": (label_union, LABEL_UNION),
    "quality_scores": (quality_scores, _quality_sql()),
}
