"""Queries that ask sources in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import text as t
from larder.operators.ladder import first_hits, lookup
from larder.plans import views as v

#: Terms of a search, the first that has hits counts.
TERMS = ("branded", "canonical", "plain")


def _goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("product_name")
    canonical = t.name_builder(name)
    return v.grocery(spark, sf_dir).withColumns(
        {"branded": F.lower(F.concat_ws(" ", "brand", canonical)), "canonical": canonical, "plain": F.lower(name), "kind": F.char_length(name) % 4}
    )


def source_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's first search term that the source knows, its three first hits, and the first of them that has a name.

    The source is the goods under one phrase each: some by brand and name, some by
    one of two names, some by none; not all of its entries have a name.
    """
    goods = _goods(spark, sf_dir)
    phrase = F.when(F.col("kind") == 0, F.col("branded")).when(F.col("kind") == 1, F.col("canonical")).when(F.col("kind") == 2, F.col("plain"))
    title = F.when(F.col("product_id") % 3 != 0, F.concat_ws(" ", "product_name", "weight"))
    source = goods.select(F.col("product_id").alias("entry"), phrase.alias("phrase"), title.alias("title"))
    ask = lookup(source, "phrase", "entry", 3)
    hits = first_hits(goods.select("product_id", *TERMS), "product_id", [ask(term) for term in TERMS])
    best = F.min(F.when(F.col("title").isNotNull(), F.struct("hit", "title")))
    return hits.groupBy("product_id", "rung").agg(F.count("*").alias("hits"), F.min("entry").alias("first"), best["title"].alias("best"))


def _source_ladder_sql() -> str:
    from larder.plans.stats import _builder_name_sql

    canonical = _builder_name_sql("product_name")
    return f"""WITH {v.GROCERY_SQL}, g AS (SELECT *, {canonical} AS canonical, lower(brand || ' ' || {canonical}) AS branded, lower(product_name) AS plain, length(product_name) % 4 AS kind FROM v_grocery),
s AS (SELECT product_id AS entry, CASE kind WHEN 0 THEN branded WHEN 1 THEN canonical WHEN 2 THEN plain END AS phrase, CASE WHEN product_id % 3 <> 0 THEN product_name || ' ' || weight END AS title FROM g),
f AS (SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY entry) AS hit FROM s WHERE phrase IS NOT NULL QUALIFY hit <= 3),
a AS (SELECT product_id, 0 AS rung, branded AS term FROM g UNION ALL SELECT product_id, 1, canonical FROM g UNION ALL SELECT product_id, 2, plain FROM g),
m AS (SELECT product_id, rung, entry, hit, title FROM a JOIN f ON term = phrase QUALIFY rung = min(rung) OVER (PARTITION BY product_id))
SELECT product_id, rung, count(*) AS hits, min(entry) AS first, first(title ORDER BY hit) FILTER (WHERE title IS NOT NULL) AS best FROM m GROUP BY product_id, rung"""


QUERIES = {"source_ladder": (source_ladder, _source_ladder_sql())}
