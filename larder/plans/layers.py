"""Queries over layered documents, numeric profiles and keyed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.operators.keeping import shared_dir
from larder.operators.overlay import documents, overlaid
from larder.operators.profiles import breaks, nearest_break, outermost_break
from larder.plans import views as v
from larder.sources import buckets


def layered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the votes on a product come to, each vote a document of one of three forms, the later over the earlier."""
    # a product's votes are met as narrow rows, before documents are made of them: then each task sends one row for a product's path,
    # and what it sorts is small
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    votes = v.vote(spark, sf_dir).select("product_id", "ord", "cents", "value", "other", "quantity").repartition(n, "product_id")
    form = (F.col("ord") % 3).cast("int")
    at = F.col("ord") * 100_000_000 + F.col("cents")  # some votes share their number
    document = (
        F.when(form == 0, F.to_json(F.struct(F.struct("cents").alias("price"), F.col("value").alias("flag"))))
        .when(form == 1, F.to_json(F.struct(F.col("cents").alias("price"), F.struct(F.struct("quantity").alias("last")).alias("seen"))))
        .otherwise(F.concat(F.lit('{"price":{"unit":"'), "other", F.lit('"},"seen":{}}')))
    )
    laid = documents(overlaid(votes.select("product_id", at.alias("at"), document.alias("document")), "product_id", "at", "document"))
    return laid.select(F.col("key").alias("product_id"), "document")


LAYERED_DOCUMENTS = f"""WITH {v.VOTE}, f AS (SELECT * REPLACE (ord * 100000000 + cents AS ord), ord % 3 AS form FROM v_vote),
l AS (SELECT *, max(CASE WHEN form = 1 THEN ord END) OVER (PARTITION BY product_id) AS leaf FROM f),
a AS (SELECT product_id, max(ord) FILTER (WHERE form <> 1) AS map, max(leaf) AS leaf, arg_max(cents, ord) FILTER (WHERE form = 1) AS plain,
  arg_max(cents, ord) FILTER (WHERE form = 0 AND (leaf IS NULL OR ord > leaf)) AS cents, arg_max(other, ord) FILTER (WHERE form = 2 AND (leaf IS NULL OR ord > leaf)) AS unit,
  arg_max(value, ord) FILTER (WHERE form = 0) AS flag, arg_max(quantity, ord) FILTER (WHERE form = 1) AS quantity, bool_or(form <> 0) AS seen FROM l GROUP BY product_id)
SELECT product_id, '{{' || concat_ws(',', '"flag":"' || flag || '"',
  '"price":' || CASE WHEN leaf IS NULL OR map > leaf THEN '{{' || concat_ws(',', '"cents":' || cents, '"unit":"' || unit || '"') || '}}' ELSE plain::VARCHAR END,
  CASE WHEN seen THEN '"seen":' || coalesce('{{"last":{{"quantity":' || quantity || '}}}}', '{{}}') END) || '}}' AS document FROM a"""


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's prices in time, numbered from 0, and how many."""
    lines = v.read(spark, sf_dir, "lineitem").withColumn("level", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    in_time = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "level")
    return lines.select(F.col("l_suppkey").alias("series"), (F.row_number().over(in_time) - 1).alias("place"), "level", F.count("*").over(Window.partitionBy("l_suppkey")).alias("h"))


_PROFILE = """o AS (SELECT l_suppkey AS series, round(l_extendedprice * 100)::BIGINT AS level, l_shipdate, l_orderkey, l_linenumber FROM lineitem),
p AS (SELECT series, level, row_number() OVER (PARTITION BY series ORDER BY l_shipdate, l_orderkey, l_linenumber, level) - 1 AS place, count(*) OVER (PARTITION BY series) AS h FROM o)"""


def profile_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each series the strongest twentieth of its jumps: the one nearest to where a header ends, and to where a footer begins, counted from the end."""
    found = breaks(_profile(spark, sf_dir), "series", "place", "level", percentile=fixed.BREAK_PERCENTILE)
    head = nearest_break(found, "series", "place", fixed.HEADER_AT, fixed.BREAK_TOLERANCE).select("series", F.lit("header").alias("edge"), F.col("place").cast("bigint").alias("size"), "jump")
    foot = nearest_break(found, "series", "place", fixed.FOOTER_AT, fixed.BREAK_TOLERANCE).select("series", F.lit("footer").alias("edge"), (F.col("n") - F.col("place")).alias("size"), "jump")
    return head.union(foot)


_NEAR = """SELECT series, '{edge}' AS edge, {size} AS size, jump FROM c WHERE abs(place - floor(h * {at}::DOUBLE)) <= floor(h * {off}::DOUBLE)
QUALIFY row_number() OVER (PARTITION BY series ORDER BY abs(place - floor(h * {at}::DOUBLE)), place) = 1"""
PROFILE_BREAKS = f"""WITH {_PROFILE}, d AS (SELECT *, abs(lead(level) OVER (PARTITION BY series ORDER BY place) - level) AS jump FROM p),
t AS (SELECT series, quantile_cont(jump::DOUBLE, {fixed.BREAK_PERCENTILE}) AS most FROM d WHERE jump IS NOT NULL GROUP BY series),
c AS (SELECT d.* FROM d JOIN t USING (series) WHERE jump > most)
{_NEAR.format(edge='header', size='place', at=fixed.HEADER_AT, off=fixed.BREAK_TOLERANCE)} UNION ALL {_NEAR.format(edge='footer', size='h - place', at=fixed.FOOTER_AT, off=fixed.BREAK_TOLERANCE)}"""


def profile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jumps of two deviations in either half of a series: the first below the top margin, and the last above the bottom one, counted from the end."""
    p = _profile(spark, sf_dir)
    upper = breaks(p.where("place < h div 2"), "series", "place", "level", deviations=fixed.EDGE_DEVIATIONS, keep=["h"])
    lower = p.where("place >= h div 2").withColumn("place", F.expr("place - h div 2"))
    lower = breaks(lower, "series", "place", "level", deviations=fixed.EDGE_DEVIATIONS, keep=["h"])
    head = outermost_break(upper, "series", "place", f"place > h * {fixed.HEADER_MARGIN}D")
    foot = outermost_break(lower, "series", "place", f"place < n * {fixed.FOOTER_LIMIT}D", first=False)
    head = head.select("series", F.lit("header").alias("edge"), F.col("place").cast("bigint").alias("size"), "jump")
    return head.union(foot.select("series", F.lit("footer").alias("edge"), (F.col("n") - F.col("place")).alias("size"), "jump"))


_HALF = """{name} AS (SELECT series, place - {off} AS place, level, h, count(*) OVER (PARTITION BY series) AS n FROM p WHERE place {sign} h // 2),
{name}_d AS (SELECT *, abs(lead(level) OVER (PARTITION BY series ORDER BY place) - level) AS jump FROM {name}),
{name}_c AS (SELECT *, jump > {deviations}::DOUBLE * stddev_pop(jump::DOUBLE) OVER (PARTITION BY series) AS breaks FROM {name}_d)"""
PROFILE_EDGES = f"""WITH {_PROFILE}, {_HALF.format(name='head', off='0', sign='<', deviations=fixed.EDGE_DEVIATIONS)}, {_HALF.format(name='foot', off='h // 2', sign='>=', deviations=fixed.EDGE_DEVIATIONS)}
SELECT series, 'header' AS edge, place AS size, jump FROM head_c WHERE breaks AND place > h * {fixed.HEADER_MARGIN}::DOUBLE QUALIFY row_number() OVER (PARTITION BY series ORDER BY place) = 1
UNION ALL SELECT series, 'footer', n - place, jump FROM foot_c WHERE breaks AND place < n * {fixed.FOOTER_LIMIT}::DOUBLE QUALIFY row_number() OVER (PARTITION BY series ORDER BY place DESC) = 1"""


def bucket_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry's last entry of each worker, kept in a bucketed table that takes in the entries by their status."""
    table = f"{shared_dir(spark)}/larder-workers-{uuid.uuid4().hex}"
    entries = v.registry(spark, sf_dir).select("worker", "file_id", "status", "duration")
    schema = entries.schema
    for number, status in enumerate(dict.fromkeys(s for _, s in v.STATUS)):
        buckets.upsert_batch(table, entries.where(F.col("status") == status), number, ["worker"], "file_id", schema, 16)
    return buckets.current(spark, table, schema)


BUCKET_UPSERTS = f"WITH {v.REGISTRY} SELECT worker, file_id, status, duration FROM v_registry QUALIFY row_number() OVER (PARTITION BY worker ORDER BY file_id DESC) = 1"

QUERIES = {
    "layered_documents": (layered_documents, LAYERED_DOCUMENTS),
    "profile_breaks": (profile_breaks, PROFILE_BREAKS),
    "profile_edges": (profile_edges, PROFILE_EDGES),
    "bucket_upserts": (bucket_upserts, BUCKET_UPSERTS),
}
