"""Prefix sums within groups that may be larger than a task should hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch


def prefix_sums(df: DataFrame, by: list[str], order: list[str], sums: dict[str, str], scratch: Scratch | None = None) -> DataFrame:
    """Add exclusive prefix sums: for each group of `by`, over the rows before in `order`.

    sums: SQL expression -> output column. Rows are range-partitioned by group
    and order, so a large group is spread over partitions; each partition's
    total for its last group, and for its first, is then carried over. Those
    totals are two rows a partition at most for each group that spans a border,
    and are kept on Spark: a partition starts with the totals of its first group
    in the partitions before it.
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    ranged = scratch.keep(ranged.withColumn("_part", F.spark_partition_id()))
    # a group's total in each partition it reaches, summed over the partitions before
    totals = ranged.groupBy(*by, "_part").agg(*[F.sum(F.expr(e)).alias(f"_{o}") for e, o in sums.items()])
    spans = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_part").alias("_at"),
        *[F.coalesce(F.sum(f"_{o}").over(spans), F.lit(0)).alias(f"_{o}") for o in sums.values()],
    ).where(" or ".join(f"_{o} <> 0" for o in sums.values()))
    here = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumns({f"_in_{o}": F.coalesce(F.sum(F.expr(e)).over(here), F.lit(0)) for e, o in sums.items()})
    on = [F.col("_part") == F.col("_at"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    # at most one carried row for each partition, as only its first group began before it
    out = inner.join(F.broadcast(carried), on, "left")
    return out.select(
        *df.columns,
        *[(F.col(f"_in_{o}") + F.coalesce(f"_{o}", F.lit(0))).alias(o) for o in sums.values()],
    )
