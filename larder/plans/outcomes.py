"""Outcomes of batches, what a discovery found, and providers' kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.operators.providers import Provider, Providers
from larder.plans import views as v


def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per job: records of its files, a failed or unfinished one as a record of no confidence; labels with some; inputs that were there."""
    lines, orders = v.read(spark, sf_dir, "lineitem"), v.read(spark, sf_dir, "orders")
    done = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R")
    confidence = F.when(done, 100 - F.round(F.col("l_discount") * 1000).cast("int")).otherwise(0)
    failed = F.when(~done, F.when(F.col("l_returnflag") == "R", "failed").otherwise("unfinished"))
    per = lines.select(F.col("l_orderkey").alias("job_id"), confidence.alias("confidence"), failed.alias("error")).groupBy("job_id").agg(
        F.count("*").alias("records"), F.count_if(F.col("confidence") > 0).alias("labels"), F.count("error").alias("errors"),
        F.count_if(F.col("error") == "failed").alias("failed"), F.sum("confidence").alias("confidence"),
    )
    inputs = F.array(
        F.when(F.col("records").isNotNull(), F.lit("files")), F.when(F.col("labels") > 0, F.lit("labels")),
        F.when(F.col("o_orderstatus") != "P", F.lit("status")), F.when(F.col("o_totalprice") > 100_000, F.lit("prices")),
    )
    joined = orders.join(per, F.col("o_orderkey") == F.col("job_id"), "left").where("records is not null")
    return joined.select("job_id", "records", "labels", "errors", "failed", "confidence", F.array_join(F.array_compact(inputs), ",").alias("inputs"))


BATCH_OUTCOMES = """WITH l AS (SELECT l_orderkey AS job_id, l_returnflag AS flag, l_linestatus = 'F' AND l_returnflag <> 'R' AS done, 100 - round(l_discount * 1000)::INT AS c FROM lineitem),
p AS (SELECT job_id, count(*) AS records, count(*) FILTER (WHERE done AND c > 0) AS labels, count(*) FILTER (WHERE NOT done) AS errors,
  count(*) FILTER (WHERE flag = 'R') AS failed, sum(CASE WHEN done THEN c ELSE 0 END)::BIGINT AS confidence FROM l GROUP BY job_id)
SELECT job_id, records, labels, errors, failed, confidence, concat_ws(',', 'files', CASE WHEN labels > 0 THEN 'labels' END, CASE WHEN o_orderstatus <> 'P' THEN 'status' END,
  CASE WHEN o_totalprice > 100000 THEN 'prices' END) AS inputs FROM orders JOIN p ON o_orderkey = job_id"""


def discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capture (a size) the main category of most goods, its subcategories and how many, as the summary's rows."""
    goods = v.grocery(spark, sf_dir).withColumn("category", F.coalesce(t.category(F.col("description")), F.lit("Unknown")))
    per = goods.groupBy("size", "category").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("product_name")).alias("names"))
    top = per.groupBy("size").agg(F.max(F.struct("n", "category", "names")).alias("b"), F.sum("n").alias("goods"))
    return top.select(
        "size", F.col("b.category").alias("category"), F.array_join("b.names", "; ").alias("subcategories"), F.size("b.names").alias("found"), "goods"
    )


def _discovery_sql() -> str:
    from larder.plans.stats import _category_sql

    return f"""WITH {v.GROCERY_SQL}, c AS (SELECT size, product_name, coalesce({_category_sql('description')}, 'Unknown') AS category FROM v_grocery),
p AS (SELECT size, category, count(*) AS n, list_sort(list(DISTINCT product_name)) AS names FROM c GROUP BY ALL)
SELECT size, category, array_to_string(names, '; ') AS subcategories, len(names)::INT AS found, (sum(n) OVER (PARTITION BY size))::BIGINT AS goods FROM p
QUALIFY row_number() OVER (PARTITION BY size ORDER BY n DESC, category DESC) = 1"""


#: What each provider does to a name here; images are not in the tables.
KERNELS = (F.lower, F.upper, F.initcap, F.reverse)


def provider_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as the best provider within each product's budget makes them, and what it costs; some providers are down for some sizes."""
    known = Providers(Provider(name, kernel, cents, speed, quality) for kernel, (name, cents, speed, quality) in zip(KERNELS, fixed.IMAGE_PROVIDERS))
    names = F.array(*[F.lit(n) for n in known.names()])
    up = F.filter(names, lambda n: F.pmod(F.col("size") + F.char_length(n), F.lit(3)) != 0)
    goods = v.grocery(spark, sf_dir).withColumn("provider", known.best(F.col("cents") % 25, up))
    return known.run(goods, "provider", "product_name", "made", "cost").select("product_id", "provider", "made", F.coalesce("cost", F.lit(0)).alias("cost"))


def _provider_kernels_sql() -> str:
    rows = ", ".join(f"('{n}', {c}, {s}, {q}, {k})" for k, (n, c, s, q) in enumerate(fixed.IMAGE_PROVIDERS))
    return f"""WITH {v.GROCERY_SQL}, k(name, cents_each, speed, quality, place) AS (VALUES {rows}),
b AS (SELECT product_id, name, cents_each FROM v_grocery JOIN k ON cents_each <= cents % 25 AND (size + length(name)) % 3 <> 0
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY quality DESC, speed DESC, cents_each, place) = 1)
SELECT product_id, name AS provider, CASE name WHEN 'local' THEN lower(product_name) WHEN 'remove_bg' THEN upper(product_name)
  WHEN 'photoroom' THEN array_to_string(list_transform(string_split(lower(product_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') WHEN 'removal_ai' THEN reverse(product_name) END AS made, coalesce(cents_each, 0)::INT AS cost
FROM v_grocery LEFT JOIN b USING (product_id)"""


QUERIES = {
    "batch_outcomes": (batch_outcomes, BATCH_OUTCOMES),
    "discovery": (discovery, _discovery_sql()),
    "provider_kernels": (provider_kernels, _provider_kernels_sql()),
}
